"""Text cleaning as column expressions.

Everything but two steps runs inside whole-stage codegen. Spark has no NFKD and
no full entity table, so those two go through one Arrow UDF that is handed null
for every row that needs neither; such rows cross to Python as a null only.
"""

from __future__ import annotations

import re
import string
from html import entities

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters Python counts as white space, besides the plain
# space; Java's \\s is ASCII only. Single characters below 256 compile to one bit
# set, which is several times faster than \\s or a range; the outer range lets most
# of the other characters fail in one comparison.
_LATIN_SPACE = r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0"
_WIDE_SPACE = r"[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]"
_ODD_SPACE = f"{_LATIN_SPACE}{_WIDE_SPACE}"

_ATTRIBUTES = r"""(?:[^'">]++|"[^"]*+"|'[^']*+')*+"""

# One left-to-right pass, so whichever construct starts first wins: a comment
# mark inside a script is script, a tag inside a comment is comment.
# Possessive loops run without recursion and never step back: neither an unclosed
# tag nor a long row of tags costs more than its length.
_BLOCKS = [  # elements whose content is not text, and what ends them besides their end tag
    *[(tag, r"\z") for tag in ("script", "style", "template")],
    *[(tag, r"(?=</ruby\s*>)|\z") for tag in ("rt", "rp")],
]
_BLOCK = "|".join(rf"{tag}(?=[\s/>]){_ATTRIBUTES}(?<!/)>.*?(?:</{tag}\s*>|{end})" for tag, end in _BLOCKS)
MARKUP = rf"(?:<(?:!--.*?-->|{_BLOCK}|[a-z/]{_ATTRIBUTES}>|[!?][^>]*+>))++"

# Entities decoded without leaving the JVM. ``amp`` is last, so
# that "&amp;lt;" becomes "&lt;" and is not decoded twice.
ENTITIES = {
    "lt": "<",
    "gt": ">",
    "quot": '"',
    "apos": "'",
    "#39": "'",
    "#039": "'",
    "nbsp": "\u00a0",
    "copy": "©",
    "reg": "®",
    "middot": "·",
    "ndash": "–",
    "mdash": "—",
    "lsquo": "‘",
    "rsquo": "’",
    "ldquo": "“",
    "rdquo": "”",
    "bull": "•",
    "hellip": "…",
    "amp": "&",
}
_MARK = "\uffff"  # a noncharacter
_RARE_ENTITY = rf"&(?!(?:{'|'.join(ENTITIES)});)[#a-zA-Z]"


# A byte search costs a fraction of a regular expression, so it goes first.


def _if_has(col: Column, part: str, changed: Column) -> Column:
    return F.when(F.contains(col, F.lit(part)), changed).otherwise(col)


def _non_ascii(col: Column) -> Column:
    return F.octet_length(col) != F.char_length(col)


def _has_rare_entity(col: Column) -> Column:
    return F.contains(col, F.lit("&")) & col.rlike(_RARE_ENTITY)


# -- markup ---------------------------------------------------------------


def _open_cdata(col: Column) -> Column:
    """The text of a CDATA section counts, so only its marks become markup."""
    return _if_has(col, "<![CDATA[", F.regexp_replace(col, r"(?s)<!\[CDATA\[(.*?)\]\]>", "<!>$1<!>"))


def strip_markup(col: Column, mark: str = " ") -> Column:
    """Each run of tags, comments, declarations and non-text blocks becomes a space."""
    return _if_has(col, "<", F.regexp_replace(_open_cdata(col), f"(?is){MARKUP}", mark))


def _common_entities(col: Column) -> Column:
    decoded = col
    for name, char in ENTITIES.items():
        decoded = F.replace(decoded, F.lit(f"&{name};"), F.lit(char))
    return _if_has(col, "&", decoded)


# A reference ends at ";" or before a character that cannot continue it; at the
# very end of the text it is not complete and stays as it is.
_REFERENCE = re.compile(r"&(?:#([xX][0-9a-fA-F]+|[0-9]+)(?:;|(?=[^0-9a-fA-F;]))|([a-zA-Z][-.a-zA-Z0-9]*)(?:;|(?=[^a-zA-Z0-9;])))")


def _decode_reference(match: re.Match) -> str:
    number, name = match.groups()
    if name:
        return entities.html5.get(f"{name};") or entities.html5.get(name) or f"&{name}"
    code = int(number[1:], 16) if number[0] in "xX" else int(number)
    if code < 256:  # low numbers mean Windows-1252 in practice
        return bytes([code]).decode("cp1252", errors="ignore") or chr(code)
    if code > 0x10FFFF or 0xD800 <= code < 0xE000:
        return "\ufffd"
    return chr(code)


def _decode(texts: pa.Array) -> pa.Array:
    if texts.null_count == len(texts):
        return texts
    out = [None if t is None else _REFERENCE.sub(_decode_reference, t) for t in texts.to_pylist()]
    return pa.array(out, texts.type)


@F.arrow_udf(T.StringType())
def _decode_udf(raw: pa.Array) -> pa.Array:
    return _decode(raw)


@F.arrow_udf(T.StringType())
def _nfkd_udf(text: pa.Array) -> pa.Array:
    return pc.utf8_normalize(text, form="NFKD")


@F.arrow_udf(T.StringType())
def _decode_nfkd_udf(raw: pa.Array, plain: pa.Array) -> pa.Array:
    return pc.utf8_normalize(pc.coalesce(_decode(raw), plain), form="NFKD")


def _needs_decode(marked: Column) -> Column:
    return F.when(_has_rare_entity(marked), marked)


def _needs_nfkd(marked: Column, plain: Column) -> Column:
    return F.when(_non_ascii(plain) & ~_has_rare_entity(marked), plain)


def html_text(col: Column | str) -> Column:
    """Visible text of an HTML fragment with one space between two text nodes.

    Markup is marked by a code point no text holds. It parts nodes, and it ends a
    reference without a semicolon, also where it is last; then the marks go.
    """
    marked = strip_markup(F.coalesce(_col(col), F.lit("")), _MARK)
    decoded = F.coalesce(_decode_udf(_needs_decode(marked)), _common_entities(marked))
    return F.replace(F.regexp_replace(decoded, rf"\A{_MARK}|{_MARK}\z", ""), F.lit(_MARK), F.lit(" "))


# -- unicode and white space ----------------------------------------------


def nfkd(col: Column | str) -> Column:
    """Unicode NFKD; ASCII text never leaves the JVM."""
    col = _col(col)
    return F.coalesce(_nfkd_udf(F.when(_non_ascii(col), col)), col)


def normalize_ws(col: Column | str) -> Column:
    """Runs of white space become one space; none at either end.

    Two passes that rarely match beat one that matches every space.
    """
    plain = F.regexp_replace(_col(col), f"[{_ODD_SPACE}]++", " ")
    return F.trim(_if_has(plain, "  ", F.regexp_replace(plain, "  ++", " ")))


def strip_ws(col: Column | str) -> Column:
    """Remove white space at both ends only."""
    ws = f"[ {_ODD_SPACE}]"
    return F.regexp_replace(_col(col), rf"\A{ws}++|(?<!{ws}){ws}++\z", "")


# -- the full chain ---------------------------------------------------------


def clean_text(col: Column | str) -> Column:
    """Markup out, NFKD, white space collapsed; null or empty gives ''.

    For whole frames ``clean_columns`` is cheaper: it strips the markup once.
    """
    marked = strip_markup(F.coalesce(_col(col), F.lit("")))
    plain = _common_entities(marked)
    decoded = _decode_nfkd_udf(_needs_decode(marked), _needs_nfkd(marked, plain))
    return normalize_ws(F.coalesce(decoded, plain))


def clean_columns(df: DataFrame, *names: str) -> DataFrame:
    """``clean_text`` on several columns with one Python exchange for all of them."""
    marked = {f"_marked_{n}": strip_markup(F.coalesce(F.col(n), F.lit(""))) for n in names}
    plain = {f"_plain_{n}": _common_entities(F.col(f"_marked_{n}")) for n in names}
    decoded = {
        f"_decoded_{n}": _decode_nfkd_udf(
            _needs_decode(F.col(f"_marked_{n}")), _needs_nfkd(F.col(f"_marked_{n}"), F.col(f"_plain_{n}"))
        )
        for n in names
    }
    final = {n: normalize_ws(F.coalesce(F.col(f"_decoded_{n}"), F.col(f"_plain_{n}"))) for n in names}
    staged = df.withColumns(marked).withColumns(plain).withColumns(decoded).withColumns(final)
    return staged.drop(*marked, *plain, *decoded)


# -- corpus preparation -----------------------------------------------------


def corpus_clean(col: Column | str) -> Column:
    """Lower case, keep ASCII letters, digits and white space, collapse runs."""
    spaced = F.regexp_replace(F.lower(_col(col)), _WIDE_SPACE, " ")
    kept = F.regexp_replace(spaced, f"[^{string.ascii_letters}{string.digits} {_LATIN_SPACE}]++", "")
    return normalize_ws(kept)


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
