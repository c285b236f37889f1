"""Mix sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ids import dense_id
from ..operators.staging import stage
from .ranks import positions

# What separates words is space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST_COPIES = 3


def word_count(text: str = "text") -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Add `target` to rows (source, source_size): the words the mix wants from each.

    Sources in order of their code points, null last, get the weights in turn. All words together are shared by weight;
    a target stops at `most` times its source's size, and the excess is shared again among the others until none is above.
    Each round is one aggregate of two numbers; the rounds end because each caps at least one more source.
    """
    shares = F.array(*[F.lit(int(w)) for w in weights])
    place = (F.col("__rank") - 1) % len(weights)
    ranked = dense_id(sources, [F.col("source").isNull(), F.col("source")], "__rank")
    ranked = stage(
        ranked.select(
            "source", "source_size", F.get(shares, place).cast("bigint").alias("__w"), (F.col("source_size") * most).alias("__cap")
        ),
        "sources",
    )
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        above = F.col("__cap") <= F.lit(level) * F.col("__w")
        row = ranked.agg(
            F.sum(F.when(above, F.col("__cap"))).alias("cap"),
            F.sum(F.when(~above, F.col("__w"))).alias("w"),
            F.count_if(above).alias("n"),
        ).first()
        if row.w is None or row.n == capped:
            break
        level, capped = (total - (row.cap or 0)) / row.w, row.n
    target = F.least(F.col("__cap").cast("double"), F.lit(float(level)) * F.col("__w"))
    return ranked.select("source", "source_size", target.alias("target"))


def mix(rows: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES, seed: str = "mix") -> DataFrame:
    """Add source_size, target, copies and taken to rows that have doc_id, source and size (a whole number, not null).

    Within a source every document expects target / source_size copies. The expectations are added up along the source in
    order of size, equal sizes at random; with one random offset for the source, a document is emitted once per whole
    number that its stretch crosses. Since the order is by size, every size gives its share and the words taken come
    close to the target. No document is taken more than `most` times. The same rows give the same result: the offset is a
    digest of the source and the seed.

    Null sources are one source, null doc_ids are ordered first, repeated rows are documents of their own, and a source
    without any words has target 0 and nothing taken. An empty table gives an empty result. Other columns stay, but
    for ones named like the four added. `rows` is read three times: stage what is costly to compute.
    """
    added = ("source_size", "target", "copies", "taken")
    rows = rows.drop(*added)
    kept = [F.col(f"`{c}`") for c in rows.columns]
    sources = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    sources = sources.select(F.col("source").alias("__source"), "source_size", "target")
    placed = positions(rows, ["source"], ["size"], ["doc_id"], "__position")
    placed = placed.join(sources, F.col("source").eqNullSafe(F.col("__source")))
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("source"), F.lit("|"))))
    offset = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    crossed = lambda n: F.floor(n * F.col("__rate") + F.col("__offset"))
    placed = placed.withColumn("__rate", rate).withColumn("__offset", offset)
    copies = (crossed(F.col("__position") + 1) - crossed(F.col("__position"))).cast("bigint")
    placed = placed.withColumn("copies", copies)
    return placed.select(*kept, "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def emit(mixed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The mix itself: every document as many times as it has copies."""
    many = mixed.filter("copies > 0")
    return many.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies"))).select(*[f"`{c}`" for c in columns])


def op4(docs: DataFrame) -> DataFrame:
    sized = stage(docs.select("doc_id", "source", word_count().alias("size")), "sized")
    return mix(sized).select("doc_id", "size", "source_size", "target", "taken", "copies")


OP4_SQL = r"""
with d as (
  select doc_id, source, md5(coalesce(cast(doc_id as varchar), '')) as tie,
         cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size
  from documents),
s as (select source, cast(sum(size) as bigint) as source_size from d group by source),
w as (select *, 3 * source_size as cap, (row_number() over (order by source nulls last) - 1) % 3 + 1 as w from s),
c as (
  select *, sum(source_size) over () as total,
         coalesce(sum(cap) over (order by cast(cap as double) / w, source nulls last rows between unbounded preceding and 1 preceding), 0) as capped,
         sum(w) over (order by cast(cap as double) / w desc, source desc nulls first rows between unbounded preceding and current row) as open_w
  from w),
l as (select max(cast(total - capped as double) / cast(open_w as double)) as level from c),
t as (select source, source_size, least(cast(cap as double), level * w) as target from c, l),
p as (select d.*, row_number() over (partition by source order by size, tie, doc_id) - 1 as pos from d),
r as (
  select p.doc_id, p.size, t.source_size, t.target, p.pos,
         case when t.source_size > 0 then t.target / t.source_size else 0.0 end as rate,
         cast(('0x' || substr(md5('mix|' || coalesce(p.source, '|')), 1, 8)) as bigint) / 4294967296.0 as u
  from p join t on p.source is not distinct from t.source),
k as (select *, cast(floor((pos + 1) * rate + u) - floor(pos * rate + u) as bigint) as copies from r)
select doc_id, size, source_size, target, copies * size as taken, copies from k
"""
