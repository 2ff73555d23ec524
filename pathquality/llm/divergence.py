"""How far the sources of a language differ in the words they use.

Texts are lower-cased, split, dictionary-encoded and counted by Arrow's own kernels, batch by
batch; the partial counts merge in Spark. Everything after works on one row per (lang, source,
term) or less:

value of a pair (g, h) = sum of f(p_g, p_h) over all kept terms of the language. Most terms are
missing from most sources, and a missing term has the same p everywhere in its source. So, with
p0 the p of a missing term,

  V f(p0_g, p0_h)                                    as if no source had any term
  + sum over terms of g of f(p_g, p0_h) - f(p0_g, p0_h)      from the histogram of g's counts
  + sum over terms of h of f(p0_g, p_h) - f(p0_g, p0_h)      from the histogram of h's counts
  + what the terms that both have change beyond that         from columnar shards of terms

which is exact, as all sums are of whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ready, stored

DOCUMENTS = 3          # a kept term occurs in at least so many documents of its language
TOP_TERMS = 200
UNIT = 1_000_000_000
PER_SHARD = 200_000    # rows (source, term) of one shard, about
PER_BLOCK = 1_000      # sources whose pairs one task sums, about

SEPARATORS = "[\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_COUNTS = "lang string, source string, term string, n long, docs long"


def _partial(batch: pa.RecordBatch) -> pa.Table:
    """Occurrences and documents of every (lang, source, term) of a batch; with a null term, of
    every (lang, source)."""
    lang, source = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
    width = max(1, len(source.dictionary))
    group = pc.add(pc.multiply(lang.indices.cast(pa.int64()), width), source.indices.cast(pa.int64()))
    words = pc.split_pattern_regex(pc.ascii_lower(batch.column("text").cast(pa.large_string())), pattern=SEPARATORS)
    row, word = pc.list_parent_indices(words), pc.list_flatten(words).dictionary_encode()
    found = pa.table({"row": row, "word": word.indices})
    empty = pc.index(word.dictionary, pa.scalar("", word.dictionary.type)).as_py()
    if empty >= 0:
        found = found.filter(pc.not_equal(found.column("word"), empty))
    by_row = found.group_by(["row", "word"], use_threads=False).aggregate([([], "count_all")])
    by_group = pa.table({
        "group": group.take(by_row.column("row").combine_chunks()), "word": by_row.column("word"),
        "n": by_row.column("count_all")}).group_by(["group", "word"], use_threads=False).aggregate(
        [("n", "sum"), ("n", "count")])
    rows = pa.table({"group": group}).group_by("group", use_threads=False).aggregate([([], "count_all")])
    groups = pa.concat_arrays([by_group.column("group").combine_chunks(), rows.column("group").combine_chunks()])
    text = pa.string()
    return pa.table([
        lang.dictionary.take(pc.divide(groups, width)).cast(text),
        source.dictionary.take(pc.subtract(groups, pc.multiply(pc.divide(groups, width), width))).cast(text),
        pa.concat_arrays([word.dictionary.take(by_group.column("word").combine_chunks()).cast(text),
                          pa.nulls(rows.num_rows, text)]),
        pa.concat_arrays([by_group.column("n_sum").combine_chunks(), pa.array(np.zeros(rows.num_rows, np.int64))]),
        pa.concat_arrays([by_group.column("n_count").combine_chunks(), rows.column("count_all").combine_chunks()]),
    ], names=["lang", "source", "term", "n", "docs"])


def _partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield from _partial(batch).to_batches()


def term_counts(docs: DataFrame) -> DataFrame:
    """`lang`, `source`, `term`, `n` occurrences, `docs` documents; one more row with a null term
    for every (lang, source), with n 0 and all its documents."""
    ready(docs.sparkSession)
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return texts.mapInArrow(_partials, _COUNTS).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _p(n: str, total: str) -> Column:
    """1 + floor(UNIT * (n + 1) / total), exact for any long."""
    return F.expr(f"1L + (cast({n} as decimal(20,0)) + 1) * {UNIT} div cast(greatest({total}, 1L) as decimal(20,0))")


def _f(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q}) div {q})"


def _divergence(p: np.ndarray | int, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _shared(key: tuple, rows: pa.Table) -> pa.Table:
    """For the sources of a block and every other one: what the shard's terms that both have add
    to the sum."""
    term = rows.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
    order = np.argsort(term, kind="stable")
    term = term[order]
    names = rows.column("source").combine_chunks().dictionary_encode()
    source = names.indices.to_numpy()[order]
    p, p0, block = (rows.column(c).to_numpy()[order] for c in ("p", "p0", "own"))
    first = np.searchsorted(term, np.arange(term[-1] + 2 if len(term) else 1))
    n_sources = len(names.dictionary)
    by_source = np.argsort(source, kind="stable")
    ends = np.searchsorted(source[by_source], np.arange(n_sources + 1))
    left, right, value = [], [], []
    for g in range(n_sources):
        mine = by_source[ends[g]:ends[g + 1]]
        if block[mine[0]] != key[2].as_py():
            continue
        size = first[term[mine] + 1] - first[term[mine]]
        at = np.repeat(first[term[mine]] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        own, own0 = np.repeat(p[mine], size), p0[mine[0]]
        more = (_divergence(own, p[at]) - _divergence(own, p0[at])
                - _divergence(own0, p[at]) + _divergence(own0, p0[at]))
        total = np.zeros(n_sources, dtype=np.int64)
        np.add.at(total, source[at], more)
        total[g] = 0
        others = np.flatnonzero(total)
        left.append(np.full(len(others), g))
        right.append(others)
        value.append(total[others])
    if not left:
        left = right = value = [np.empty(0, dtype=np.int64)]
    left, right, value = (np.concatenate(x).astype(np.int64) for x in (left, right, value))
    return pa.table([
        pa.array([key[0].as_py()] * len(left), pa.string()), names.dictionary.take(pa.array(left)),
        names.dictionary.take(pa.array(right)), pa.array(value)], names=["lang", "source", "item", "value"])


def _pairs(scored: DataFrame, groups: DataFrame, per_shard: int, per_block: int) -> DataFrame:
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    base = groups.select("lang", "source", "p0", "terms").join(other, "lang").filter("source <> item").select(
        "lang", "source", "item", F.expr(f"if(terms = 0, 0L, terms * {_f('p0', 'q0')})").alias("value"))
    histogram = scored.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("m"))
    alone = histogram.join(other, "lang").filter("source <> item").groupBy("lang", "source", "item").agg(
        F.sum(F.expr(f"m * ({_f('p', 'q0')} - {_f('p0', 'q0')})")).alias("value"),
        F.sum(F.expr(f"m * ({_f('q0', 'p')} - {_f('q0', 'p0')})")).alias("turned"))
    alone = alone.select("lang", F.explode(F.array(
        F.struct("source", "item", "value"),
        F.struct(F.col("item").alias("source"), F.col("source").alias("item"), F.col("turned").alias("value")),
    )).alias("s")).select("lang", "s.*")
    blocks = F.ceil(F.col("sources") / per_block).cast("long")
    shared = scored.filter("holders > 1").select(
        "lang", "source", "term", "p", "p0",
        F.pmod(F.xxhash64("term"), F.ceil(F.col("rows") / per_shard).cast("long")).alias("shard"),
        F.pmod(F.xxhash64("source"), blocks).alias("own"),
        F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block"))
    shared = shared.groupBy("lang", "shard", "block").applyInArrow(
        _shared, "lang string, source string, item string, value long")
    return base.unionByName(alone).unionByName(shared).groupBy("lang", "source", "item").agg(
        F.sum("value").alias("value"))


def divergences(docs: DataFrame, documents: int = DOCUMENTS, top_terms: int = TOP_TERMS,
                per_shard: int = PER_SHARD, per_block: int = PER_BLOCK) -> DataFrame:
    """`lang`, `source`, `part`, `item`, `value`, `rank`.

    Part `pair`: how far each source is from each other one of its language; part `term`: the
    `top_terms` kept terms that a source uses more than its language, farthest first. A term is a
    run of A-Z (lower-cased), a-z and characters beyond ASCII; a language keeps the terms of at
    least `documents` of its documents. Equal values are ranked by the item's UTF-8.

    Null text, lang and source count as ''. Every row is a document, rows that repeat a doc_id and
    whole repeated rows too. A source without any term has the p of missing terms throughout; a
    language without kept terms has pairs of value 0 and no terms; a source that is alone in its
    language has no pairs. An empty table gives no rows. Other columns are not read.
    """
    counts = stored(term_counts(docs), "divergence-counts")
    term = Window.partitionBy("lang", "term")
    kept = counts.filter("term is not null").select(
        "lang", "source", "term", "n", F.sum("n").over(term).alias("n_lang"),
        F.sum("docs").over(term).alias("in_docs"), F.count("*").over(term).alias("holders"),
        (F.row_number().over(term.orderBy("source")) == 1).cast("long").alias("new"),
    ).filter(F.col("in_docs") >= documents).drop("in_docs")
    kept = stored(kept, "divergence-kept")

    sums = kept.groupBy("lang", "source").agg(
        F.sum("n").alias("n"), F.sum("new").alias("new"), F.count("*").alias("rows"))
    lang = Window.partitionBy("lang")
    zero = F.lit(0).cast("long")
    groups = counts.filter("term is null").select("lang", "source").join(sums, ["lang", "source"], "left").select(
        "lang", "source", F.coalesce("n", zero).alias("total"),
        F.coalesce(F.sum("n").over(lang), zero).alias("total_lang"),
        F.coalesce(F.sum("new").over(lang), zero).alias("terms"),
        F.coalesce(F.sum("rows").over(lang), zero).alias("rows"), F.count("*").over(lang).alias("sources"))
    groups = stored(groups.withColumn("p0", _p("0", "total + terms")), "divergence-groups")

    scored = kept.join(groups, ["lang", "source"]).withColumns({
        "p": _p("n", "total + terms"), "q": _p("n_lang", "total_lang + terms")})
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = scored.filter("p > q").select("lang", "source", F.col("term").alias("item"),
                                          F.expr(_f("p", "q")).alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top_terms)
    pairs = _pairs(scored, groups, per_shard, per_block).withColumn("rank", F.row_number().over(best))
    return pairs.withColumn("part", F.lit("pair")).unionByName(terms.withColumn("part", F.lit("term"))).select(
        "lang", "source", "part", "item", "value", "rank")


DIVERGENCE_SQL = """
with docs as (
    select row_number() over () as doc, coalesce(lang, '') as lang, coalesce(source, '') as source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
    from documents
), words as (
    select doc, lang, source,
           unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
    from docs
), kept as (
    select lang, term, count(*) as n from words group by lang, term having count(distinct doc) >= 3
), groups as (
    select distinct lang, source from docs
), held as (
    select w.lang, w.source, w.term, count(*) as n
    from words w semi join kept k on k.lang = w.lang and k.term = w.term
    group by w.lang, w.source, w.term
), v as (
    select lang, count(*) as v, sum(n) as n from kept group by lang
), own as (
    select g.lang, g.source, coalesce(sum(h.n), 0) as n
    from groups g left join held h on h.lang = g.lang and h.source = g.source group by g.lang, g.source
), p as (
    select g.lang, g.source, k.term, coalesce(h.n, 0) as n,
           1 + (1000000000::hugeint * (coalesce(h.n, 0) + 1)::hugeint) // (g.n + v.v)::hugeint as p,
           1 + (1000000000::hugeint * (k.n + 1)::hugeint) // (v.n + v.v)::hugeint as q
    from own g join kept k on k.lang = g.lang join v on v.lang = g.lang
    left join held h on h.lang = g.lang and h.source = g.source and h.term = k.term
), pairs as (
    select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) as value
    from p a join p b on b.lang = a.lang and b.term = a.term and b.source <> a.source
    group by a.lang, a.source, b.source
), found as (
    select a.lang, a.source, 'pair' as part, b.source as item, coalesce(x.value, 0) as value
    from groups a join groups b on b.lang = a.lang and b.source <> a.source
    left join pairs x on x.lang = a.lang and x.source = a.source and x.item = b.source
    union all
    select lang, source, 'term', term, ((p - q) * (p - q)) // q from p where n > 0 and p > q
), ranked as (
    select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from found
)
select lang, source, part, item, value::bigint as value, rank::int as rank
from ranked where part = 'pair' or rank <= 200
"""
