"""Secrets in texts, judged by who owns them across the corpus.

Every text gives its spans by pattern (``base``), and besides them candidates: long runs of
key characters with both letters and digits in them. A candidate's value is hashed, and
Spark counts over the whole corpus in how many distinct repositories and at how many
distinct owners it stands. Copies of one document are one repository. A value that several
owners carry in several repositories is a copied example, sample or identifier, and so is
one in many repositories whoever owns them; any other looks like a live credential of its
owner and is added as kind ``owned``. Base spans stay whatever their counts are, with the
verdict beside them. Native functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import cut, fresh


@dataclass(frozen=True)
class Pattern:
    """A kind of span: what to match, which group must have how many characters."""

    kind: str
    regex: str
    group: int
    least: int
    # a text without any of these, letters in either case, has no match
    needs: tuple[str, ...] = ()


# Kinds in the order in which spans at one place are listed.
BASE = (
    Pattern(
        "assign",
        r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        1,
        6,
        ("passw", "secret", "token", "api"),
    ),
    Pattern("access", r"(AKIA[A-Z0-9]+)", 1, 20, ("akia",)),
    # only runs that are long enough: leftmost, so a run is taken whole
    Pattern("hex", r"([0-9a-f]{24,})", 1, 24),
)
OWNED = "owned"
# Whole runs of 16 or more key characters; only those with a letter and a digit count.
CANDIDATE = Pattern(OWNED, r"([A-Za-z0-9+/_-]{16,})", 1, 16)
# A value beyond both of the first two bounds, or beyond the third, is a copied example.
MAX_OWNERS = 1
MAX_REPOS = 1
MANY_REPOS = 20
_SPAN = "array<struct<start:int,rank:int,kind:string,end:int,value:string>>"


def matches(text: Column, pattern: Pattern, rank: int) -> Column:
    """Leftmost matches that do not overlap, as (start, rank, kind, end, value), in code points.

    The text between the matches and the matches themselves alternate, so the lengths
    before a match add up to its start.
    """
    found = F.regexp_extract_all(text, F.lit(pattern.regex), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern.regex), F.lit(pattern.group))
    lengths = F.zip_with(
        F.slice(F.split(text, pattern.regex, -1), 1, F.size(found)),
        F.arrays_zip(found.alias("found"), values.alias("value")),
        lambda before, m: F.struct(
            F.length(before).alias("gap"), F.length(m["found"]).alias("size"), m["value"].alias("value")
        ),
    )
    empty = F.array().cast(_SPAN)
    placed = F.aggregate(
        lengths,
        F.struct(F.lit(0).alias("at"), empty.alias("spans")),
        lambda state, x: F.struct(
            (state["at"] + x["gap"] + x["size"]).alias("at"),
            F.concat(
                state["spans"],
                F.array(
                    F.struct(
                        (state["at"] + x["gap"]).alias("start"),
                        F.lit(rank).alias("rank"),
                        F.lit(pattern.kind).alias("kind"),
                        (state["at"] + x["gap"] + x["size"]).alias("end"),
                        x["value"].alias("value"),
                    )
                ),
            ).cast(_SPAN).alias("spans"),
        ),
        lambda state: state["spans"],
    )
    kept = F.filter(placed, lambda s: F.length(s["value"]) >= pattern.least)
    may = text.rlike(pattern.regex)
    if pattern.needs:
        low = F.lower(text)
        any_of = low.contains(pattern.needs[0])
        for word in pattern.needs[1:]:
            any_of = any_of | low.contains(word)
        may = any_of & may
    return F.when(may, kept).otherwise(empty)


def ownership(found: DataFrame) -> DataFrame:
    """(value, n_repos, n_owners) of the rows (value, repo, owner).

    A task folds equal rows before the shuffle, and both counts are taken of distinct
    pairs, spread by pair: a value, repository or owner with much of the corpus does
    not meet in one task. Nulls count as no repository and no owner.
    """
    owners = found.select("value", "owner").distinct().groupBy("value").agg(F.count("owner").alias("n_owners"))
    repos = found.select("value", "repo").distinct().groupBy("value").agg(F.count("repo").alias("n_repos"))
    return owners.join(repos, "value")


def scan_spans(text: Column) -> Column:
    """A struct of the base spans and of the candidates of one text, each in order."""
    base = F.array_sort(F.concat(*(matches(text, p, i) for i, p in enumerate(BASE))))
    more = F.filter(
        matches(text, CANDIDATE, len(BASE)), lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]")
    )
    hashed = lambda spans: F.transform(
        spans,
        lambda s: F.struct(s["start"], s["rank"], s["kind"], s["end"], F.sha2(s["value"].cast("binary"), 256).alias("hash")),
    )
    return F.struct(hashed(base).alias("base"), hashed(more).alias("more"))


def scan_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    max_owners: int = MAX_OWNERS,
    max_repos: int = MAX_REPOS,
    many_repos: int = MANY_REPOS,
) -> DataFrame:
    """(id, text_key, base, spans, n_copied), one row per row of ``docs``.

    ``base`` and ``spans`` are arrays of (start, rank, kind, end), code points, end exclusive,
    sorted; ``spans`` are the base ones and the ``owned`` ones that touch no base span.
    ``n_copied`` counts spans and candidates whose value is copied: more than ``max_owners``
    owners carry it in more than ``max_repos`` repositories, or it stands in more than
    ``many_repos`` repositories. ``text_key`` is the text's MD5, by which the spans can be
    joined to texts again.

    A distinct text is a repository, its documents' ``owner_col`` the owners. A null text is an
    empty one. A null owner is no owner, so a value at null owners only is owned until it
    stands in many repositories. Rows come back as often as they went in; an empty table stays
    empty.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = cut(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(owner_col).alias("owner"),
            F.md5(text.cast("binary")).alias("text_key"),
            scan_spans(text).alias("found"),
        )
    )
    hashes = F.array_distinct(F.transform(F.concat("found.base", "found.more"), lambda s: s["hash"]))
    values = found.select("owner", "text_key", F.explode(hashes).alias("value")).distinct()
    several = (F.col("n_owners") > max_owners) & (F.col("n_repos") > max_repos)
    counted = ownership(values.withColumnRenamed("text_key", "repo"))
    copied = counted.filter(several | (F.col("n_repos") > many_repos)).select("value")
    # of one text, so no longer than the text
    by_text = (
        values.select("text_key", "value")
        .distinct()
        .join(copied, "value", "left_semi")
        .groupBy("text_key")
        .agg(F.collect_list("value").alias("copied"))
    )
    listed = lambda s: F.struct(s["start"], s["rank"], s["kind"], s["end"])
    base, more = F.col("found.base"), F.col("found.more")
    copies = F.coalesce("copied", F.array().cast("array<string>"))
    is_copied = lambda s: F.array_contains(copies, s["hash"])
    clear = lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    owned = F.filter(more, lambda s: ~is_copied(s) & clear(s))
    return found.join(by_text, "text_key", "left").select(
        F.col("id").alias(id_col),
        "text_key",
        F.transform(base, listed).alias("base"),
        F.array_sort(F.transform(F.concat(base, owned), listed)).alias("spans"),
        F.size(F.filter(F.concat(base, more), is_copied)).alias("n_copied"),
    )


def span_list(spans: Column | str) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def mask(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by its kind in square brackets; spans that touch merge."""
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))
    hidden = F.aggregate(
        spans,
        state,
        lambda state, s: F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(
                s["start"] >= state["at"],
                F.concat(state["done"], text.substr(state["at"] + 1, s["start"] - state["at"]), F.lit("["), s["kind"], F.lit("]")),
            )
            .otherwise(state["done"])
            .alias("done"),
        ),
        lambda state: F.concat(state["done"], text.substr(state["at"] + 1, F.length(text))),
    )
    return F.when(F.size(spans) > 0, hidden).otherwise(text)


def mask_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    max_owners: int = MAX_OWNERS,
    max_repos: int = MAX_REPOS,
    many_repos: int = MANY_REPOS,
) -> DataFrame:
    """``docs`` with every secret in ``text_col`` masked; all rows stay, null texts stay null.

    Texts with spans are few, and equal texts have equal spans: they are joined by the
    text's MD5, and texts that have none keep what they are.
    """
    key, spans = fresh(docs, "text_key", "spans")
    scanned = scan_secrets(docs, id_col, text_col, owner_col, max_owners, max_repos, many_repos).filter(F.size("spans") > 0)
    by_text = scanned.groupBy(F.col("text_key").alias(key)).agg(F.min("spans").alias(spans))
    keyed = docs.withColumn(key, F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))
    masked = mask(F.col(text_col), F.coalesce(F.col(spans), F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")))
    columns = [masked.alias(c) if c == text_col else F.col(c) for c in docs.columns]
    return keyed.join(by_text, key, "left").select(*columns)
