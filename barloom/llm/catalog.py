"""The registered queries of this package and the SQL that checks them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import archive, decontaminate, hilbert, ngram_join, periodic, pieces, quality, records, secrets, spelling, suffix_dedup, toxicity, url_filter
from barloom.llm.expressions import let

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SHARDS = 40


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_JOIN_SQL = """
with recursive words as (
  select doc_id, text, list_filter(regexp_split_to_array(coalesce(text, ''), '\\s+'), lambda w: w <> '') as w from documents
), grams as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as g from words
), n as (select doc_id, count(*) as n from grams group by doc_id),
common as (
  select a.doc_id as x, b.doc_id as y, count(*) as c from grams a join grams b on a.g = b.g and a.doc_id <> b.doc_id group by all
), links as materialized (
  select x, y from common join n p on p.doc_id = x join n q on q.doc_id = y where c >= 0.8 * (p.n + q.n - c) - 1e-9
), reach(x, y) as (select x, y from links union select reach.x, links.y from reach join links on reach.y = links.x),
least as (select x, least(x, min(y)) as class_id from reach group by x),
degree as (select x, count(*) as n_links from links group by x),
same as (select a.doc_id as x, count(*) as n_copies from words a join words b on a.text = b.text and a.doc_id <> b.doc_id
  where len(a.w) > 0 group by a.doc_id)
select doc_id, coalesce(class_id, doc_id) as class_id, coalesce(n_links, 0) as n_links, coalesce(n_copies, 0) as n_copies
from words left join least on least.x = doc_id left join degree on degree.x = doc_id left join same on same.x = doc_id
"""


@query("op1_ngram_jaccard_join", _JOIN_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


@query("op2_hilbert_shards")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", "n_chars",
        (F.octet_length(body) + 16).cast("bigint").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )
    placed = hilbert.hilbert_shards(rows, "doc_id", ["source", "lang", "n_chars"], SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve",
    )


@query("op3_sentencepiece")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


@query("op4_decontamination")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = decontaminate.benchmark_items(table(spark, sf_dir, "benchmark"))
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), items)


def _in_sql(words) -> str:
    return ", ".join(f"'{w}'" for w in dict.fromkeys(words))


_RULES_SQL = " and ".join(f"{r.measure} between {r.low} and {r.high}" for r in quality.RULES)
_QUALITY_SQL = f"""
with base as (select doc_id, coalesce(text, '') as t from documents),
parts as (
  select doc_id, t, list_filter(regexp_split_to_array(t, '[ \\t-\\r]+'), lambda x: x <> '') as w,
    list_filter(string_split(t, chr(10)), lambda x: length(translate(x, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) > 0) as l
  from base
),
windows as (select doc_id, i, array_to_string(w[i:i + 4], ' ') as g from parts, unnest(range(1, len(w) - 3)) as u(i)),
twice as (select doc_id, i from windows qualify count(*) over (partition by doc_id, g) > 1),
covered as (select doc_id, count(distinct i + k) as n from twice, range(5) as s(k) group by doc_id),
counts as (
  select parts.doc_id, len(w) as n_words,
    length(translate(t, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) as word_chars,
    length(t) - length(translate(t, '#*$%&|<>', '')) as n_symbols,
    len(l) as n_lines, len(l) - len(list_distinct(l)) as n_dup_lines, coalesce(covered.n, 0) as n_repeat_words,
    len(list_filter(w, lambda x: lower(x) in ({_in_sql(quality.STOP_WORDS)}))) as n_stops
  from parts left join covered using (doc_id)
),
measures as (
  select *, coalesce(word_chars / nullif(n_words, 0), 0) as mean_word_chars,
    coalesce(n_symbols / nullif(n_words, 0), 0) as symbol_ratio, coalesce(n_stops / nullif(n_words, 0), 0) as stop_ratio,
    coalesce(n_dup_lines / nullif(n_lines, 0), 0) as dup_line_ratio,
    coalesce(n_repeat_words / nullif(n_words, 0), 0) as repeat_word_ratio,
    n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed
  from counts
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and {_RULES_SQL} as kept
from measures
"""


@query("op5_quality_rules", _QUALITY_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = quality.quality_measures(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return quality.apply_rules(measured).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), (~base_failed & F.col("passes")).alias("kept"),
    )


def _kind_sql(kind: secrets.Kind, rank: int) -> str:
    """Places of a kind's matches from the lengths of the matches and of the text between them."""
    pattern = kind.pattern.replace("'", "''")
    return f"""
select doc_id, source, '{kind.name}' as kind, {rank} as rank, s[i] as secret,
  list_sum(list_transform(b[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) as a,
  list_sum(list_transform(b[1:i], lambda x: length(x))) + list_sum(list_transform(m[1:i], lambda x: length(x))) as z
from (select doc_id, source, regexp_extract_all(t, '{pattern}', 0) as m, regexp_extract_all(t, '{pattern}', {kind.value}) as s,
  string_split_regex(t, '{pattern}') as b from base), unnest(range(1, len(m) + 1)) as u(i) where length(s[i]) >= {kind.least}"""


_BASE_NAMES = _in_sql(k.name for k in secrets.BASE_KINDS)
_SECRETS_SQL = f"""
with base as (select doc_id, source, coalesce(text, '') as t from documents),
found as materialized ({" union all ".join(_kind_sql(k, i) for i, k in enumerate([*secrets.BASE_KINDS, *secrets.OWNED_KINDS]))}),
owners as (select secret, count(distinct coalesce(source, '')) as n_repositories,
  count(distinct coalesce(string_split(source, '/')[1], '')) as n_owners from found group by secret),
spans as (select found.*, n_owners <= {secrets.MAX_OWNERS} and n_repositories <= {secrets.MAX_REPOSITORIES} as live
  from found join owners using (secret)),
listed as (
  select doc_id, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
    count(*) filter (kind = 'hex') as n_hex,
    string_agg(kind || ':' || a || ':' || z, ',' order by a, rank) filter (kind in ({_BASE_NAMES})) as base,
    string_agg(kind || ':' || a || ':' || z, ',' order by a, rank) filter (kind in ({_BASE_NAMES}) or live) as spans,
    count(*) filter (live) as n_live
  from spans group by doc_id
)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(listed.base, '')) as base_sha256, coalesce(spans, '') as spans, coalesce(n_live, 0) as n_live
from documents left join listed using (doc_id)
"""


@query("op6_secret_scan", _SECRETS_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    names = [k.name for k in secrets.BASE_KINDS]
    base = secrets.span_list(F.filter("spans", lambda s: s["kind"].isin(*names)))
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(base.cast("binary"), 256).alias("base_sha256"), secrets.span_list(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("bigint").alias("n_live"),
    )


_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_ARCHIVE_SQL = f"""
with hashed as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as h from pages
), coded as (
  select *, array_to_string(list_transform(range(0, 32), lambda i: substr('{_LETTERS}',
    ((('0x' || substr(h, 5 * (i // 4) + 1, 5))::bigint >> (15 - 5 * (i % 4))) & 31) + 1, 1)), '') as payload_digest,
    min(page_id) over (partition by h) as first from hashed
)
select page_id, payload_bytes, payload_digest, case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id <> first then first end as refers_to
from coded
"""


@query("op7_warc_zip", _ARCHIVE_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.archive_round_trip(table(spark, sf_dir, "pages"))


@query("op8_token_records")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.records_round_trip(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = toxicity.fit(documents, table(spark, sf_dir, "labels"))
    scored = toxicity.score(documents.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


_REPEATS_SQL = """
with base as (select doc_id, hex(encode(coalesce(text, ''))) as h, strlen(coalesce(text, '')) as n_bytes from documents),
windows as (select doc_id, p, substr(h, 2 * p + 1, 100) as w from base, unnest(range(0, n_bytes - 49)) as u(p)),
late as (select doc_id, p from windows qualify doc_id > min(doc_id) over (partition by w)),
steps as (select doc_id, p, lag(p) over (partition by doc_id order by p) as before from late),
spans as (
  select doc_id, min(p) as a, max(p) + 50 as z
  from (select *, sum((before is null or p > before + 50)::int) over (partition by doc_id order by p) as s from steps)
  group by doc_id, s
),
gaps as (
  select doc_id, a, z, coalesce(lag(z) over (partition by doc_id order by a), 0) as last, n_bytes, h
  from spans join base using (doc_id)
),
kept as (
  select doc_id, count(*) as n_spans, sum(z - a) as n_removed, string_agg(substr(h, 2 * last + 1, 2 * (a - last)), '' order by a)
    || max_by(substr(h, 2 * z + 1), z) as k
  from gaps group by doc_id
)
select doc_id, n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(k, h))) as kept_sha256
from base left join kept using (doc_id)
"""


@query("op10_suffix_dedup", _REPEATS_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


URL_RULES = [
    url_filter.rule("allow", "org/"),
    url_filter.rule("block", "example.org/es/"),
    url_filter.rule("block", "example.org/en/1"),
    url_filter.rule("allow", "com/fr/"),
    url_filter.rule("block", "com/de/"),
]
_RULE_ROWS = ", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in URL_RULES)
_URL_SQL = f"""
with rules(h, p, v) as (values {_RULE_ROWS}),
parts as (
  select page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', ['host', 'path']) as x from pages
), named as (
  select page_id, translate(x.host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, x.path as path from parts
), fitting as (
  select page_id, host, path, h || p as rule, v
  from named left join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p)
  qualify row_number() over (partition by page_id order by length(h) desc nulls last, length(p) desc nulls last) = 1
)
select page_id, host, path, rule, coalesce(v, 'allow') as verdict from fitting
"""


@query("op11_url_filter", _URL_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


_SPELLING_SQL = """
with recursive steps as (
  select list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, k: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t
), runs as (
  select doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as r
  from (select doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) as r from documents)
), counted as (
  select doc_id, r, count(*) as k, hex(encode(coalesce(doc_id::varchar, '') || ':' || r)) as x from runs group by doc_id, r
), hashed as (
  select r, k, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(0, length(x), 2), lambda i: ('0x' || substr(x, i + 1, 2))::bigint)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) as h
  from counted, steps
), words as materialized (
  select word, sum(k)::bigint as n
  from (select k, case when h % 31 = 0 then substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) else r end as word from hashed)
  where length(word) >= 7 group by word having sum(k) >= 2
), gaps as materialized (
  select word, n, i, substr(word, 1, i) || substr(word, i + 2) as g from words, unnest(range(length(word))) as u(i)
), near as (
  select a.word, b.word as other, b.n as m from gaps a join gaps b on a.i = b.i and a.g = b.g and a.word <> b.word
  union select gaps.word, words.word, words.n from gaps join words on gaps.g = words.word
  union select words.word, gaps.word, gaps.n from gaps join words on gaps.g = words.word
), best as (
  select word, count(*) as n_near, max(m) as m, arg_min(other, other) filter (m = top) as form
  from (select *, max(m) over (partition by word) as top from near) group by word
), forms as materialized (
  select words.word, n, coalesce(n_near, 0) as n_near, case when m >= 10 * n then form end as form, case when m >= 10 * n then m end as form_n
  from words left join best using (word)
), chain(word, form, step) as (
  select word, form, 1 from forms where form is not null
  union all select chain.word, forms.form, step + 1 from chain join forms on forms.word = chain.form where forms.form is not null
), roots as (select word, arg_max(form, step) as root from chain group by word)
select word, form, coalesce(root, word) as root, n, n_near, form_n from forms left join roots using (word)
"""


@query("op12_spelling_groups", _SPELLING_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.vocabulary(table(spark, sf_dir, "documents"))
    return spelling.group_spellings(words).select("word", "form", "root", "n", "n_near", "form_n")


def with_planted_period(df: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; of a tenth of the texts the end repeats a stretch of its own.

    With h the crc32 of the decimal doc_id and g = h div 10, a text with h % 10 = 0 and n > 0 words is
    periodic from word a = g % n on, with period 1 + (n - a) div (3 + g % 8). Others stay as they are, also
    those without a doc_id.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = ((h - h % 10) / 10).cast("bigint")

    def changed(words):
        n = F.greatest(F.size(words), F.lit(1))
        a = (g % n).cast("int")
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("int")
        place = lambda i, x: F.when(i < x["a"], i).otherwise(x["a"] + (i - x["a"]) % x["p"])
        turned = lambda x: F.transform(words, lambda _, i: F.get(words, place(i, x)))
        return F.array_join(let(F.struct(a.alias("a"), p.alias("p")), turned), " ")

    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return df.select("doc_id", F.when(h % 10 == 0, let(words, changed)).otherwise(F.col("text")).alias("text"))


@query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find_runs(with_planted_period(table(spark, sf_dir, "documents")))
    # Runs come by start, then period, so of equal exponents the first one stays.
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    better = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    best = F.reduce("runs", none, lambda best, r: F.when(better(best, r), r).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), "collapsed_sha256",
    )
