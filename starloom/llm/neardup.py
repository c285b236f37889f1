"""Near-duplicates from SetSketch registers of word shingles."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.staging import stage
from .components import components
from .spread import most_rows, spread_join


@dataclass(frozen=True)
class Settings:
    shingle: int = 5  # words
    percent: int = 85  # least share of the union that two sets must have in common, in whole percent
    bands: int = 32
    rows: int = 5  # registers of a band
    base: float = 1.001  # registers grow by one when a minimum falls by this factor
    rate: float = 20.0
    slack: float = 5.0  # standard errors below the threshold at which an estimate still leads to an exact check
    seed: int = 5

    @property
    def registers(self) -> int:
        return self.bands * self.rows


TOP = 65535  # registers are 16 bits wide


def words_of(text: str) -> list[bytes]:
    """Words in lower case (A to Z only), cut at ASCII blanks: bytes.lower and bytes.split do exactly that."""
    return text.encode("utf-8", "replace").lower().split()


def shingles(words: list[bytes], size: int) -> np.ndarray:
    """The set of a text as sorted 64-bit hashes: its shingles, or the whole of it if it is shorter."""
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], dtype=np.uint64)
    of_word = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    n = len(words) - size + 1
    mixed = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        mixed = (mixed ^ of_word[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def sketch(hashes: np.ndarray, settings: Settings) -> np.ndarray:
    """SetSketch registers: for each of the register's own orders of all values, the least value of the set, on a scale of
    powers of the base, cut off at either end. The sketch of a union is the larger register of each.
    """
    random = np.random.default_rng(settings.seed)
    factors = random.integers(0, 1 << 32, settings.registers, dtype=np.uint32) | np.uint32(1)
    shifts = random.integers(0, 1 << 32, settings.registers, dtype=np.uint32)
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(settings.registers, 0xFFFFFFFF, dtype=np.uint32)
    for a in range(0, len(x), 2048):
        values = x[None, a : a + 2048] * factors[:, None]
        values += shifts[:, None]
        np.minimum(least, values.min(axis=1), out=least)
    exponential = -np.log1p(-(least.astype(np.float64) + 0.5) / 2**32) / settings.rate
    return np.clip(np.floor(1 - np.log(exponential) / np.log(settings.base)), 0, TOP).astype("<u2")


def similarity(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, base: float) -> np.ndarray:
    """Most likely Jaccard similarity of sets, given both sketches (a row each) and the sizes of the sets.

    A register is larger in a with probability p(u - v J), in b with p(v - u J), else equal, where u and v are the shares
    of the sizes and p(x) = -log_base(1 - x (base - 1) / base). The likelihood has one maximum, found by halving.
    """
    u = size_a / (size_a + size_b)
    v = 1 - u
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - more - less
    step = (base - 1) / base
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * step) / np.log(base)
    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)

    def slope(j: np.ndarray) -> np.ndarray:
        up, down = np.maximum(u - v * j, 1e-12), np.maximum(v - u * j, 1e-12)
        d = lambda x: step / np.log(base) / (1 - x * step)
        equal = np.maximum(1 - p(up) - p(down), 1e-12)
        return -more * v * d(up) / p(up) - less * u * d(down) / p(down) + same * (v * d(up) + u * d(down)) / equal

    for _ in range(40):
        middle = (low + high) / 2
        rising = slope(middle) > 0
        low, high = np.where(rising, middle, low), np.where(rising, high, middle)
    return (low + high) / 2


def sketches(docs: DataFrame, settings: Settings) -> DataFrame:
    """(doc_id, digest, n_shingles, key, registers): the digest is Spark's of the text, the key is a 128-bit hash of the words; key and
    registers are null for texts without words."""

    def sketched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            last: dict[bytes, tuple[int, bytes]] = {}  # copies often follow each other
            rows = []
            for doc_id, digest, text in zip(batch["doc_id"], batch["digest"], batch["text"]):
                words = words_of(text)
                if not words:
                    rows.append((doc_id, digest, 0, None, None))
                    continue
                key = xxhash.xxh3_128_digest(b" ".join(words))
                if key not in last:
                    found = shingles(words, settings.shingle)
                    last[key] = len(found), sketch(found, settings).tobytes()
                rows.append((doc_id, digest, last[key][0], key, last[key][1]))
            out = pd.DataFrame(rows, columns=["doc_id", "digest", "n_shingles", "key", "registers"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    doc_id, text = F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    texts = docs.select(doc_id, F.xxhash64("text").alias("digest"), text)
    return texts.mapInPandas(sketched, "doc_id bigint, digest bigint, n_shingles bigint, key binary, registers binary")


def _buckets(classes: DataFrame, settings: Settings) -> DataFrame:
    """(bucket, key): equal registers of a band fall in one bucket."""
    wide = 2 * settings.rows
    band = F.explode(F.sequence(F.lit(0), F.lit(settings.bands - 1))).alias("band")
    of_band = F.substring("registers", F.col("band") * wide + 1, F.lit(wide))
    return classes.select("key", "registers", band).select(F.xxhash64("band", of_band).alias("bucket"), "key")


def _with_pairs(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of the keys a with the number of pairs of each, for `spread_join`: a bucket's least key has as many as the bucket."""
    counts = pairs.groupBy(F.col("a").alias("__a")).agg(F.count(F.lit(1)).alias("__n"))
    return rows.join(counts, F.col("a") == F.col("__a")).drop("__a")


def _likely(pairs: DataFrame, classes: DataFrame, settings: Settings, most: int) -> DataFrame:
    """Of pairs (a, b), those whose sizes allow a link and whose estimate does not rule it out."""
    limit = settings.percent / 100
    least = limit - settings.slack * np.sqrt(limit * (1 - limit) / settings.registers)

    @F.pandas_udf("double")
    def estimate(a: pd.Series, b: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype="float64")
        rows = [np.frombuffer(b"".join(x), "<u2").reshape(len(x), -1).astype(np.int32) for x in (a, b)]
        return pd.Series(similarity(*rows, n.to_numpy(float), m.to_numpy(float), settings.base))

    side = lambda s: classes.select(F.col("key").alias(s), F.col("registers").alias(f"r_{s}"), F.col("n_shingles").alias(f"n_{s}"))
    both = spread_join(pairs, _with_pairs(pairs, side("a")), "a", "b", most).join(side("b"), "b")
    fits = both.filter(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * settings.percent)
    return fits.filter(estimate("r_a", "r_b", "n_a", "n_b") >= F.lit(float(least))).select("a", "b")


def _confirmed(pairs: DataFrame, sets: DataFrame, settings: Settings, most: int) -> DataFrame:
    """Of pairs (a, b), those whose full sets have enough in common. The larger key's set travels to the smaller key, which is in
    as many tasks as its pairs ask for."""

    @F.pandas_udf("boolean")
    def linked(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        for p, q in zip(x, y):
            p, q = np.frombuffer(p, "<u8"), np.frombuffer(q, "<u8")
            both = len(np.intersect1d(p, q, assume_unique=True))
            out.append(100 * both >= settings.percent * (len(p) + len(q) - both))
        return pd.Series(out, dtype=bool)

    with_b = pairs.join(sets.select(F.col("key").alias("b"), F.col("hashes").alias("s_b")), "b")
    side = _with_pairs(pairs, sets.select(F.col("key").alias("a"), F.col("hashes").alias("s_a")))
    both = spread_join(with_b, side, "a", "b", most)
    return both.filter(linked("s_a", "s_b")).select("a", "b")


def _sets(docs: DataFrame, wanted: DataFrame, settings: Settings) -> DataFrame:
    """(key, hashes): full sets of the wanted classes, from the text of the document that stands for each."""

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [words_of(t) for t in batch["text"]]
            keys = [xxhash.xxh3_128_digest(b" ".join(w)) for w in words]
            fits = [bytes(k) == bytes(w) for k, w in zip(keys, batch["key"])]  # not so for another text of a repeated id
            rows = [(k, shingles(w, settings.shingle).tobytes()) for k, w, f in zip(keys, words, fits) if f]
            yield pd.DataFrame(rows, columns=["key", "hashes"])

    texts = docs.filter("text is not null").join(wanted.withColumnRenamed("rep", "doc_id"), "doc_id").select("key", "text")
    return texts.mapInPandas(hashed, "key binary, hashes binary").dropDuplicates(["key"])


BLOCK = 256  # texts on either side of a block of comparisons


def _links_of_block(left: pd.DataFrame, right: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Exact links between texts of two blocks, from counts of common shingles, a few thousand shingles at a time."""
    right = right.rename(columns=lambda c: c.removesuffix("_"))
    sides = [[np.frombuffer(h, "<u8") for h in x["hashes"]] for x in (left, right)]
    if not all(sides):
        return pd.DataFrame({"a": [], "b": []}, dtype=object)
    known = np.intersect1d(*[np.unique(np.concatenate(s)) for s in sides])
    common = np.zeros((len(left), len(right)), dtype=np.float32)
    for start in range(0, len(known), 4096):
        part = known[start : start + 4096]
        marks = []
        for arrays in sides:
            mark = np.zeros((len(arrays), len(part)), dtype=np.float32)
            for i, hashes in enumerate(arrays):
                own = hashes[np.searchsorted(hashes, part[0]) : np.searchsorted(hashes, part[-1], side="right")]
                at = np.searchsorted(part, own)
                mark[i, at[part[at] == own]] = 1
            marks.append(mark)
        common += marks[0] @ marks[1].T
    n, m = (np.array([len(h) for h in s]) for s in sides)
    near = 100 * common >= percent * (n[:, None] + m[None, :] - common)
    near &= left["root"].to_numpy()[:, None] != right["root"].to_numpy()[None, :]
    pairs = [sorted((left["key"].iat[i], right["key"].iat[j])) for i, j in zip(*np.nonzero(near))]
    return pd.DataFrame(pairs, columns=["a", "b"])


def _strays(members: DataFrame, roots: DataFrame, sets: DataFrame, settings: Settings, most: int) -> DataFrame:
    """Links between members of a bucket that the pairs with its least key have not joined into one component.

    In each bucket only members outside its largest component are compared with others. Most of those are beyond a link with
    anybody: shingles that no other text in question has cannot be in common, so a text of n shingles of which too few are
    shared at all is left out, without a pair. The rest of a bucket is compared in blocks, full set against full set; only
    links leave a block, so neither a large bucket nor the pairs in it meet in one task.
    """
    placed = members.join(roots.select(F.col("node").alias("b"), "root"), "b", "left")
    placed = stage(placed.select("bucket", F.col("b").alias("key"), F.coalesce("root", "b").alias("root")), "placed")
    counts = placed.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    mains = counts.groupBy("bucket").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"))
    mains = mains.filter("k > 1 and n > 2").select("bucket", "main", F.col("n").alias("__n"))
    open_ = stage(spread_join(placed, mains, "bucket", "key", most), "open")
    asked = sets.join(open_.select("key").distinct(), "key")

    def exploded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, hashes in zip(batch["key"], batch["hashes"]):
                yield pd.DataFrame({"hash": np.frombuffer(hashes, "<i8"), "key": key})

    alone = asked.mapInPandas(exploded, "hash bigint, key binary").groupBy("hash")
    alone = alone.agg(F.count(F.lit(1)).alias("n"), F.first("key").alias("key")).filter("n = 1")
    alone = alone.groupBy("key").agg(F.count(F.lit(1)).alias("alone"))
    size = F.octet_length("hashes") / 8
    able = asked.join(alone, "key", "left").filter((size - F.coalesce("alone", F.lit(0))) * 100 >= size * settings.percent)
    able = stage(open_.join(able.select("key"), "key"), "able")
    stray = F.col("root") != F.col("main")
    blocks = able.groupBy("bucket").agg(F.count_if(stray).alias("strays"), F.count(F.lit(1)).alias("all"))
    blocks = blocks.filter("strays > 0 and all > 1").select(
        "bucket", *[F.ceil(F.col(n) / BLOCK).cast("int").alias(n) for n in ("strays", "all")], F.col("all").alias("__n")
    )
    able = spread_join(able, blocks, "bucket", "key", most).join(sets, "key")
    own = lambda n: F.pmod(F.xxhash64("key"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["bucket", "key", "root", "hashes"]
    left = able.filter(stray).select(*columns, own("strays").alias("i"), each("all").alias("j"))
    right = able.select(*columns, own("all").alias("j"), each("strays").alias("i"))
    percent = settings.percent
    right = right.toDF(*[f"{c}_" for c in right.columns])  # the same columns of the same rows: names tell the sides apart
    found = left.groupBy("bucket", "i", "j").cogroup(right.groupBy("bucket_", "i_", "j_"))
    return found.applyInPandas(lambda x, y: _links_of_block(x, y, percent), "a binary, b binary").distinct()


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, digest, n_shingles, component_id, group, kept) for every document; the digest is xxhash64 of the text, the group
    is one key for all texts of a component, null for texts without words.

    Texts with the same words form a class. Classes that agree in all registers of a band meet in a bucket. Buckets are not
    paired off: each member is paired with the bucket's least key, the pairs that the joint estimate does not rule out are
    confirmed on full sets, and the links give components. Members of a bucket that are then outside its largest component are
    compared with the others in blocks, so that a link between any two members is found. At the threshold a band agrees with
    probability 0.85 ** 5, so 32 bands miss a link of 85% with probability 7e-9.

    Null and empty texts have no set and are linked with nothing; null doc_ids take part but name no component (their
    component_id is that of the others, or null; they are kept only if it is null). Repeated rows are copies of one document,
    which stays as often as it is given; a doc_id with several texts stands for each of them. Other columns are not used.
    """
    docs = docs.select("doc_id", "text")
    rows = stage(sketches(docs, settings), "sketches")
    classes = rows.filter("key is not null").groupBy("key").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers")
    )
    classes = stage(classes.filter("rep is not null"), "classes")
    buckets = _buckets(classes, settings)
    most = most_rows(classes.count() * settings.bands)
    leaders = buckets.groupBy("bucket").agg(F.min("key").alias("a"), F.max("key").alias("last"), F.count(F.lit(1)).alias("__n"))
    members = spread_join(buckets, leaders.filter("a < last").select("bucket", "a", "__n"), "bucket", "key", most)
    members = stage(members.select("bucket", "a", F.col("key").alias("b")), "members")
    stars = stage(_likely(stage(members.filter("a < b").select("a", "b").distinct(), "pairs"), classes, settings, most), "stars")
    met = classes.select("key", "rep").join(members.select(F.col("b").alias("key")).distinct(), "key")
    sets = stage(_sets(docs, met, settings), "sets")
    roots = stage(components(_confirmed(stars, sets, settings, most)), "roots")
    rest = stage(_strays(members, roots, sets, settings, most), "rest")
    if not rest.isEmpty():
        joined = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))  # says as much as the links it came from
        roots = stage(components(joined.unionByName(rest)), "roots")

    named = classes.select("key", "rep").join(roots.select(F.col("node").alias("key"), "root"), "key", "left")
    named = named.withColumn("root", F.coalesce("root", "key"))
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "root").select("key", "component_id", F.col("root").alias("group"))
    all_rows = rows.select("doc_id", "digest", "n_shingles", "key").join(named, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return all_rows.select("doc_id", "digest", "n_shingles", component.alias("component_id"), "group").withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def op3(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).drop("digest", "group")
