"""The subpackage's queries on the given tables, each with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbtable.llm.decontaminate import find_benchmark_hits
from plumbtable.llm.embeddings import near_vectors
from plumbtable.llm.licenses import scan_licenses, scan_sql
from plumbtable.llm.minhash import near_duplicates
from plumbtable.llm.packing import pack_documents
from plumbtable.llm.pii import pseudonymise_documents
from plumbtable.llm.prefixes import prefix_trie, rebuilt_prefixes
from plumbtable.llm.quality import fit_quality, score_quality
from plumbtable.llm.runs import find_runs
from plumbtable.llm.secrets import find_secrets
from plumbtable.llm.substrings import remove_repeats
from plumbtable.llm.tokens import count_tokens
from plumbtable.llm.toxicity import fit_toxicity, score_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query()
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))


@query()
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    listed = F.array_join(F.transform("items", lambda i: i.cast("string")), ",")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


@query()
def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query(scan_sql())
def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.size("matches").cast("long").alias("n_matches"),
        F.size(F.array_distinct("matches.unit")).cast("long").alias("n_units"),
        F.array_join(F.array_sort(F.array_distinct("matches.license")), ",").alias("licenses"),
    )


@query()
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(listed(F.filter("spans", lambda s: s["kind"] != "guess")), 256).alias("base_sha256"),
        listed("spans").alias("spans"),
        count("guess").alias("n_guess"),
    )


@query()
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = pseudonymise_documents(table(spark, sf_dir, "documents"), kinds_col="kinds")
    return done.select("doc_id", "text", F.size("kinds").cast("long").alias("n_replaced"), F.array_join("kinds", ",").alias("kinds"))


def remainder(of: int):
    """crc32 of the id as text, modulo ``of``."""
    return F.crc32(F.col("doc_id").cast("string")) % of


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str):
    return fit_quality(docs, table(spark, sf_dir, "labels"), remainder(5) != 0)


@query()
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"), remainder(3) != 1)
    return score_toxicity(docs, model).select(
        "doc_id",
        (remainder(3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query()
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, quality_model(spark, docs, sf_dir)).select(
        "doc_id",
        (remainder(5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: the words of every text, in a tenth of the documents from some word on repeated with a period."""
    h = F.crc32(F.col("doc_id").cast("string"))
    pieces = F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+")
    g, n = F.floor(h / 10), F.size("words")
    rows = docs.select("doc_id", h.alias("h"), F.filter(pieces, lambda w: w != "").alias("words"))
    rows = rows.select("doc_id", "words", (h % 10 == 0).alias("planted"), g.alias("g"), n.alias("n"))

    def repeated(bound):
        words, a, p = bound["words"], bound["a"], bound["p"]
        later = F.transform(F.sequence(a, bound["n"] - 1), lambda i: F.get(words, (a + (i - a) % p).cast("int")))
        return F.concat(F.slice(words, 1, a.cast("int")), later)

    a = F.col("g") % F.col("n")
    p = 1 + F.floor((F.col("n") - a) / (3 + F.col("g") % 8))
    # The array of one struct keeps its parts from being worked out anew for every word.
    bound = F.array(F.struct("words", a.alias("a"), p.alias("p"), F.col("n").cast("long").alias("n")))
    made = F.when(F.col("planted") & (F.col("n") > 0), F.get(F.transform(bound, repeated), F.lit(0))).otherwise(F.col("words"))
    return rows.select("doc_id", F.array_join(made, " ").alias("text"))


@query()
def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(planted_runs(table(spark, sf_dir, "documents")))
    more = lambda a, b: a["length"] * b["period"] > b["length"] * a["period"]
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda top, r: F.when(more(r, top), r).otherwise(top))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.select("*", best.alias("best"))
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query()
def op11_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


#: CRC-32 of a text of ASCII characters: each bit is one step, a character comes in with the first of its eight.
_CRC32 = """xor(list_reduce(
    [4294967295::BIGINT] || flatten([[ascii(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0] for x in string_split({text}, '')]),
    lambda a, v: xor(xor(a, v) >> 1, (xor(a, v) & 1) * 3988292384)), 4294967295)"""

TRIE_SQL = f"""
with turns as (
    select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as txt,
        row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as i
    from conversations where conv_id is not null
),
convs as (select c, c - c % 20 as base, {_CRC32.format(text="c::varchar")} % 4 as h from (select distinct c from turns)),
rebuilt as (
    select v.c, 0 as part, t.i, t.role, t.txt from convs v join turns t on t.c = v.base and t.i <= v.h
    union all
    select v.c, 1, t.i, t.role, t.txt from convs v join turns t on t.c = v.c and t.i > v.h
),
prefixes as (
    select c, row_number() over w as d, list([role, txt]) over w as prefix, txt from rebuilt
    window w as (partition by c order by part, i)
    union all select c, 0, [], '' from convs
),
members as (select c, d, prefix, txt, d = max(d) over (partition by c) as ends from prefixes),
nodes as (
    select prefix, d, min(c) as first, count(*) as n, coalesce(string_agg(c::varchar, ',' order by c) filter (ends), '') as ids,
        (count(*) - 1) * len(regexp_extract_all(any_value(txt), '[^\\x20\\x09-\\x0D]+')) as saved
    from members group by prefix, d
),
children as (select prefix[:d - 1] as prefix, d - 1 as d, count(*) as n from nodes where d > 0 group by all),
counted as (select nodes.*, coalesce(children.n, 0) as n_children from nodes left join children using (prefix, d))
select v.first::bigint as conv_id, v.d::bigint as depth, p.first::bigint as parent_conv_id, v.n::bigint as n_convs,
    v.n_children::bigint as n_children, s.leaves::bigint as n_leaves, s.saved::bigint as saved_tokens, sha256(v.ids) as ends_sha256
from counted v
join (
    select v.prefix, v.d, count(*) filter (u.n_children = 0) as leaves, sum(u.saved) as saved
    from counted v join counted u on u.d >= v.d and u.prefix[:v.d] = v.prefix group by v.prefix, v.d
) s on s.prefix = v.prefix and s.d = v.d
left join counted p on p.d = v.d - 1 and p.prefix = v.prefix[:v.d - 1]
"""


@query(TRIE_SQL)
def op12_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.col("conv")
    head = F.crc32(conv.cast("string")) % 4
    return prefix_trie(rebuilt_prefixes(table(spark, sf_dir, "conversations"), conv - conv % 20, head, 3))
