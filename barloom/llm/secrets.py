"""Secret scans with corpus-wide ownership frequency (operator 6), in DataFrame operations only.

Candidates are found per text with their places. Their hashes are then counted over the corpus by
distinct repositories and owners: a value that many owners hold is a copied example, one that
stays with few owners looks like a live credential.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.session import written


class Kind(NamedTuple):
    """``pattern`` finds the span, ``value`` its secret part; shorter secrets are dropped."""

    name: str
    pattern: str
    value: int
    least: int


#: The kinds every scan reports, in the order that breaks ties.
BASE_KINDS = (
    Kind("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Kind("access", r"AKIA[A-Z0-9]+", 0, 18),
    Kind("hex", r"[0-9a-f]{16,}", 0, 16),
)

#: Kinds that count only where the corpus shows them to be owner-specific.
OWNED_KINDS = (
    Kind("vendor", r"(?:ghp|gho|ghs|glpat|xox[abprs]|sk|rk|hf)[_-][A-Za-z0-9_-]{16,}", 0, 16),
    Kind("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 16),
    Kind("login", r"[a-z][a-z0-9+.-]{1,15}://[^\s:/@]{1,64}:([^\s:/@]{6,64})@", 1, 6),
)

#: A value held by more owners than this, or by more repositories, is a copied example.
MAX_OWNERS = 2
MAX_REPOSITORIES = 3

_SPAN = "struct<kind:string,rank:int,from:bigint,to:bigint,hash:bigint>"


def _spans(body: Column, kind: Kind, rank: int) -> Column:
    """Leftmost non-overlapping matches as structs, without those whose secret part is short.

    A regular split gives the text between the matches; with the matches' own lengths it gives
    every match's place in code points.
    """
    matches = F.regexp_extract_all(body, F.lit(kind.pattern), F.lit(0))
    values = F.regexp_extract_all(body, F.lit(kind.pattern), F.lit(kind.value)) if kind.value else None

    def placed(found: Column, secret: Column, between: Column) -> Column:
        begin = _state(F.lit(0), F.array().cast(f"array<{_SPAN}>"))

        def step(state: Column, i: Column) -> Column:
            start = state["end"] + F.length(between[i])
            end = start + F.length(found[i])
            span = F.struct(
                F.lit(kind.name).alias("kind"),
                F.lit(rank).alias("rank"),
                start.alias("from"),
                end.alias("to"),
                F.xxhash64(secret[i]).alias("hash"),
            )
            enough = F.length(secret[i]) >= kind.least
            return F.struct(
                end.alias("end"),
                F.when(enough, F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"),
            )

        return F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), begin, step, lambda s: s["spans"])

    def located(found: Column) -> Column:
        none = F.array().cast(f"array<{_SPAN}>")
        between = F.split(body, kind.pattern, -1)
        secret = values if values is not None else found
        return F.when(F.size(found) == 0, none).otherwise(
            F.transform(F.array(F.struct(secret.alias("s"), between.alias("b"))), lambda x: placed(found, x["s"], x["b"]))[0]
        )

    return F.transform(F.array(matches), located)[0]


def _state(end: Column, spans: Column) -> Column:
    return F.struct(end.cast("bigint").alias("end"), spans.alias("spans"))


def find_candidates(df: DataFrame, text: str, kinds: Sequence[Kind], out: str) -> DataFrame:
    """Adds ``out``: the spans of all kinds, by start, then in the order of ``kinds``."""
    body = F.coalesce(F.col(text), F.lit(""))
    names = [f"_span{i}" for i in range(len(kinds))]
    # A cheap look first: most texts hold no match of a kind and skip its extraction.
    none = F.array().cast(f"array<{_SPAN}>")
    found = {n: F.when(body.rlike(k.pattern), _spans(body, k, i)).otherwise(none) for i, (n, k) in enumerate(zip(names, kinds))}
    ordered = F.array_sort(
        F.concat(*names),
        lambda a, b: F.when(a["from"] != b["from"], F.when(a["from"] < b["from"], -1).otherwise(1)).otherwise(a["rank"] - b["rank"]),
    )
    return df.withColumns(found).withColumn(out, ordered).drop(*names)


def ownership(candidates: DataFrame, hash_col: str, repository: str, owner: str) -> DataFrame:
    """Per hash: ``n_rows``, ``n_repositories``, ``n_owners``.

    Counts are first taken per (hash, repository, owner) with map-side combine, so a value that a
    third of all rows hold arrives as a few rows per task.
    """
    each = candidates.groupBy(hash_col, repository, owner).agg(F.count(F.lit(1)).alias("n"))
    return each.groupBy(hash_col).agg(
        F.sum("n").alias("n_rows"),
        F.count_distinct(F.coalesce(F.col(repository).cast("string"), F.lit(""))).alias("n_repositories"),
        F.count_distinct(F.coalesce(F.col(owner).cast("string"), F.lit(""))).alias("n_owners"),
    )


def scan_secrets(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    repository: str = "source",
    owner: Column | None = None,
    kinds: Sequence[Kind] = BASE_KINDS,
    owned_kinds: Sequence[Kind] = OWNED_KINDS,
    max_owners: int = MAX_OWNERS,
    max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """One row per input row: ``key``, ``spans`` (array of kind, rank, from, to, hash, live).

    ``spans`` holds every match of ``kinds`` and those of ``owned_kinds`` that are live: their
    value has at most ``max_owners`` owners and ``max_repositories`` repositories in the whole
    corpus. ``live`` says the same of the base spans. The owner is the part of the repository
    before a slash unless given.

    Nulls: a null text has no spans; a null key stays null; null repositories and owners count as
    one unnamed one. Repeated rows each give a row and count once per repository. Empty table: no
    rows. Other columns of ``df`` are not read, so clashing names do no harm.

    Scale: spans are found once and written without texts. Hashes join their counts after both
    sides are reduced to distinct (spans of a text); a value held by a third of all rows is one
    row per distinct span list there.
    """
    repo = F.col(repository).cast("string")
    who = owner if owner is not None else F.split(repo, "/")[0]
    found = find_candidates(
        df.select(F.col(key).alias("_key"), F.col(text).alias("_text"), repo.alias("_repo"), who.alias("_owner")),
        "_text", [*kinds, *owned_kinds], "_spans",
    ).select("_key", "_repo", "_owner", "_spans")
    found = written(found, "secret-spans")
    base = {k.name for k in kinds}
    each = found.where(F.size("_spans") > 0).select(
        "_repo", "_owner", F.explode(F.array_distinct(F.transform("_spans", lambda s: s["hash"]))).alias("hash")
    )
    counts = ownership(each, "hash", "_repo", "_owner").select(
        "hash",
        ((F.col("n_owners") <= max_owners) & (F.col("n_repositories") <= max_repositories)).alias("live"),
    )
    # Copies of a text share their span list: one row per list meets the counts.
    lists = found.where(F.size("_spans") > 0).groupBy("_spans").agg(F.first(F.lit(1)).alias("_one"))
    judged = (
        lists.select("_spans", F.explode("_spans").alias("s"))
        .join(counts.withColumnRenamed("hash", "_hash"), F.col("s.hash") == F.col("_hash"))
        .groupBy("_spans")
        .agg(F.collect_set(F.when(F.col("live"), F.col("_hash"))).alias("_live"))
    )
    marked = F.transform(
        "_spans",
        lambda s: F.struct(
            s["kind"].alias("kind"), s["rank"].alias("rank"), s["from"].alias("from"), s["to"].alias("to"),
            s["hash"].alias("hash"), F.array_contains(F.col("_live"), s["hash"]).alias("live"),
        ),
    )
    empty = F.array().cast("array<struct<kind:string,rank:int,from:bigint,to:bigint,hash:bigint,live:boolean>>")
    with_spans = (
        found.where(F.size("_spans") > 0)
        .join(judged, "_spans")
        .select(
            F.col("_key").alias(key),
            F.filter(marked, lambda s: s["kind"].isin(*base) | s["live"]).alias("spans"),
        )
    )
    without = found.where(F.size("_spans") == 0).select(F.col("_key").alias(key), empty.alias("spans"))
    return with_spans.unionByName(without)


def span_list(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["from"], s["to"])), ",")


def redact(df: DataFrame, spans: Column, text: str, mask: str) -> DataFrame:
    """Replaces the live spans of ``text``; overlapping ones become one mask."""
    live = F.filter(spans, lambda s: s["live"])
    begin = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        gap = F.substr(F.col(text), (state["at"] + 1).cast("int"), (s["from"] - state["at"]).cast("int"))
        return F.when(
            s["from"] >= state["at"],
            F.struct(s["to"].alias("at"), F.concat(state["out"], gap, F.lit(mask)).alias("out")),
        ).otherwise(F.struct(F.greatest(state["at"], s["to"]).alias("at"), state["out"].alias("out")))

    def finish(state: Column) -> Column:
        return F.concat(state["out"], F.substr(F.col(text), (state["at"] + 1).cast("int")))

    return df.withColumn(text, F.when(F.size(live) > 0, F.aggregate(live, begin, step, finish)).otherwise(F.col(text)))


def redact_live(
    df: DataFrame, key: str = "doc_id", text: str = "text", repository: str = "source", mask: str = "[secret]"
) -> DataFrame:
    """All rows and columns of ``df`` with the live secrets in ``text`` replaced by ``mask``.

    Copied examples stay as they are. Only texts with a candidate take part in the scan's joins; all
    others pass through. Rows are told apart by key, repository and text, so repeated keys are no
    trouble. Null texts stay null, repeated rows stay repeated, an empty table stays empty. Names
    that begin with ``_secret`` are refused.
    """
    clash = [c for c in df.columns if c.lower().startswith("_secret")]
    if clash:
        raise ValueError(f"reserved column names: {clash}")
    body = F.coalesce(F.col(text), F.lit(""))
    kinds = [*BASE_KINDS, *OWNED_KINDS]
    suspect = F.lit(False)
    for k in kinds:
        suspect = suspect | body.rlike(k.pattern)
    row = F.concat_ws(":", F.coalesce(F.col(key).cast("string"), F.lit("none")), F.coalesce(F.col(repository).cast("string"), F.lit("")), F.md5(body.cast("binary")))
    some = df.where(suspect).withColumn("_secret_row", row)
    spans = scan_secrets(some, "_secret_row", text, repository).dropDuplicates(["_secret_row"])
    spans = spans.withColumnRenamed("spans", "_secret_spans")
    masked = redact(some.join(spans, "_secret_row"), F.col("_secret_spans"), text, mask)
    return df.where(~suspect).unionByName(masked.select(*df.columns))
