"""Near-duplicate documents by SetSketch registers.

A document is its set of word shingles. Of each shingle an ascending series of truncated
exponential values is drawn, one from each of ``REGISTERS`` consecutive intervals, and dealt to the
registers in an order of its own; a register keeps the least it got, on a logarithmic scale. Registers of a
union are the extremes of the registers, and equal registers are about as likely as two sets are alike.
A document needs no further interval once all its registers are filled from the ones before, which for usual lengths are two or three.

Candidates share all registers of a band. Sets that are equal are one class, so exact
copies cost nothing. Shingles that a class has alone among the candidates bound its similarity to
any other; classes that cannot be linked to a set of their bucket's sizes leave it. Links are then found in two steps, both confirmed on full sets:

1. In each band's bucket, all members against the one with the fewest shingles of its own.
2. Where a bucket still holds several components, their members against each other: pairs
   in small buckets, if the joint likelihood of their registers does not rule them out; in larger
   ones squares of blocks, so that no task holds a bucket, and only links leave a task.

Pairs inside one component need no comparison, as they change no component.

Chance of missing a link of similarity 0.85: all 25 bands differ, below 1e-7; or the
estimate is off by five standard deviations, below 1e-6. At 0.80 the bands miss about 2e-6.

Defined cases: null, empty and blank texts have no shingles and are linked with nothing; a text
of fewer than ``width`` words is one shingle; rows without id are linked with nothing, have no
component and are kept; rows with equal id are one node with all their links; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakesearch.llm.common import document_columns, table
from lakesearch.llm.components import components
from lakesearch.llm.words import WordHashes, mixed, split_words, texts_of, window_hashes
from lakesearch.session import staged

WIDTH = 5
MIN_PERCENT = 85
REGISTERS = 101  # a prime, so that every step below it visits all registers
BAND_ROWS = 4
BANDS = REGISTERS // BAND_ROWS
BASE = 1.001
RATE = 20.0
MARGIN = 5.0
SMALL_BUCKET = 48
BLOCK = 192
STAR_ROWS = 256

_U = np.uint64
_SHINGLE = 0x9E3779B97F4A7C15


def shingles(text: bytes, hashes: WordHashes, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit shingles of a text; ``bytes.lower`` changes A-Z only."""
    codes = hashes.of(split_words(text.lower()))
    if len(codes) >= width:
        return np.unique(window_hashes(codes, width, _SHINGLE))
    return mixed(window_hashes(codes, len(codes), _SHINGLE) + _U(len(codes))) if len(codes) else codes


def registers(sets: list[np.ndarray], m: int = REGISTERS) -> np.ndarray:
    """Registers (uint16) of each set, one row per set."""
    sizes = [len(s) for s in sets]
    values = np.concatenate(sets) if sets else np.zeros(0, _U)
    rows = np.repeat(np.arange(len(sets)), sizes)
    least = np.full(len(sets) * m, float(m))
    turn = mixed(values ^ _U(0xA0761D6478BD642F))
    start, step = (turn % _U(m)).astype(np.int64), (1 + (turn >> _U(32)) % _U(m - 1)).astype(np.int64)
    for interval in range(m):
        if not len(values):
            break
        draw = (mixed(values + _U(interval * 0xE7037ED1A0B428DB & (1 << 64) - 1)) >> _U(11)).astype(np.float64) * 2.0**-53
        np.minimum.at(least, rows * m + (start + interval * step) % m, interval + draw)
        open_ = (least.reshape(-1, m).max(axis=1) >= interval + 1)[rows]
        values, rows, start, step = values[open_], rows[open_], start[open_], step[open_]
    interval = np.minimum(np.floor(least), m - 1)
    left = m - interval
    with np.errstate(divide="ignore"):
        x = (np.log(m / left) - np.log1p(-np.minimum(least - interval, 1 - 2.0**-53) / left)) / RATE
        scale = np.floor(1 - np.log(x) / np.log(BASE))
    scale[np.repeat(np.array(sizes) == 0, m)] = 0
    return np.clip(scale, 0, 65535).astype(np.uint16).reshape(-1, m)


def band_keys(rows: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each row of registers."""
    quads = np.ascontiguousarray(rows[:, :BANDS * BAND_ROWS]).astype(np.uint64).reshape(-1, BANDS, BAND_ROWS)
    joined = sum(quads[:, :, i] << _U(16 * i) for i in range(BAND_ROWS))
    return mixed(mixed(joined) + np.arange(BANDS, dtype=_U) * _U(0x8EBC6AF09C88C6E3)).view(np.int64)


def likely_similarity(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity of pairs, given registers and set sizes, on a grid of hundredths."""
    above, below = (left > right).sum(axis=1), (left < right).sum(axis=1)
    same = left.shape[1] - above - below
    u = n_left / (n_left + n_right)
    v = 1 - u
    best, at = np.full(len(u), -np.inf), np.zeros(len(u))
    chance = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)
    for j in np.arange(0, 1.001, 0.01):
        more, less = np.maximum(chance(u - v * j), 1e-12), np.maximum(chance(v - u * j), 1e-12)
        got = above * np.log(more) + below * np.log(less) + same * np.log(np.maximum(1 - more - less, 1e-12))
        got = np.where(j <= np.minimum(u / v, v / u) + 0.005, got, -np.inf)
        at, best = np.where(got > best, j, at), np.maximum(best, got)
    return at


def sign(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_shingles, cls, registers): ``cls`` is a hash of the whole set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            texts = texts_of(batch)
            for at in range(0, len(texts), 256):
                sets = [shingles(t, hashes, width) for t in texts[at:at + 256]]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(at, len(sets)), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(np.array([xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets], _U).view(np.int64)),
                    pa.array([r.tobytes() for r in registers(sets)], pa.binary())], names=["doc_id", "n_shingles", "cls", "registers"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, cls long, registers binary")


def _bands(classes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = np.frombuffer(b"".join(batch.column("registers").to_pylist()), np.uint16).reshape(-1, REGISTERS)
                yield pa.RecordBatch.from_arrays([pa.array(band_keys(rows).ravel()),
                                                  pa.array(np.repeat(batch.column("cls").to_numpy(), BANDS))], names=["bucket", "cls"])

    return classes.select("cls", "registers").mapInArrow(run, "bucket long, cls long")


def _texts(docs: DataFrame, members: DataFrame, width: int) -> DataFrame:
    """(cls, text) of the members (cls, rep): the text of ``rep`` that has this set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            digests = np.array([xxhash.xxh3_64_intdigest(shingles(t, hashes, width).tobytes()) for t in texts_of(batch)], _U).view(np.int64)
            yield batch.select(["cls", "text"]).filter(pa.array(digests == batch.column("cls").to_numpy()))

    return (docs.join(members.select("cls", F.col("rep").alias("doc_id")), "doc_id").select("cls", "text")
            .mapInArrow(run, "cls long, text string"))


def _own_shingles(texts: DataFrame, width: int) -> DataFrame:
    """(cls, own): how many shingles of a class no other class among ``texts`` has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            ids, texts_ = batch.column("cls").to_numpy(), texts_of(batch)
            for at in range(0, len(texts_), 512):
                sets = [shingles(t, hashes, width) for t in texts_[at:at + 512]]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(sets).view(np.int64)),
                    pa.array(np.repeat(ids[at:at + len(sets)], [len(s) for s in sets]))], names=["shingle", "cls"])

    alone = texts.mapInArrow(run, "shingle long, cls long").groupBy("shingle").agg(F.min("cls").alias("cls"), F.max("cls").alias("other"))
    return alone.where("cls = other").groupBy("cls").agg(F.count(F.lit(1)).alias("own"))


class _Union(dict):
    def find(self, x: int) -> int:
        while self.setdefault(x, x) != x:
            self[x] = self[self[x]]
            x = self[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)
        return a != b


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, from a product of incidence matrices over the shared shingles."""
    flat_left, flat_right = np.concatenate(left), np.concatenate(right)
    shared = np.intersect1d(flat_left, flat_right)
    out = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, len(shared), 4096):
        some = shared[at:at + 4096]
        sides = []
        for sets in (left, right):
            matrix = np.zeros((len(sets), len(some)), np.float32)
            for i, s in enumerate(sets):
                inside = s[(s >= some[0]) & (s <= some[-1])]
                where = np.searchsorted(some, inside)
                matrix[i, where[some[where] == inside]] = 1
            sides.append(matrix)
        out += sides[0] @ sides[1].T
    return out.astype(np.int64)


def _links(cells: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) inside cells.

    ``cells`` has (k1, k2, k3, side, cls, comp): sides 0 and 1 of a cell are compared with each
    other, side 2 with itself, and members of one ``comp`` not at all. Of the links
    found a cell gives as many as join its members.
    """
    def compare(held: pa.Table) -> pa.Table:
        hashes, by_side = WordHashes(), {0: {}, 1: {}, 2: {}}
        for side, cls, comp, text in zip(*(held[c].to_pylist() for c in ("side", "cls", "comp", "text"))):
            if cls not in by_side[side]:
                by_side[side][cls] = (comp, shingles((text or "").encode(), hashes, width))
        a, b = (by_side[2], by_side[2]) if by_side[2] else (by_side[0], by_side[1])
        found: tuple[list, list] = ([], [])
        if a and b:
            (ids_a, sets_a), (ids_b, sets_b) = (([*x], [s for _, s in x.values()]) for x in (a, b))
            comps_a, comps_b = np.array([c for c, _ in a.values()]), np.array([c for c, _ in b.values()])
            both = _overlaps(sets_a, sets_b)
            n_a, n_b = np.array([len(s) for s in sets_a]), np.array([len(s) for s in sets_b])
            linked = (100 * both >= percent * (n_a[:, None] + n_b[None, :] - both)) & (comps_a[:, None] != comps_b[None, :])
            joined = _Union()
            for i, j in zip(*np.nonzero(linked)):
                if ids_a[i] != ids_b[j] and joined.join(ids_a[i], ids_b[j]):
                    found[0].append(ids_a[i])
                    found[1].append(ids_b[j])
        return pa.table({"a": pa.array(found[0], pa.int64()), "b": pa.array(found[1], pa.int64())})

    return cells.join(texts, "cls").groupBy("k1", "k2", "k3").applyInArrow(compare, "a long, b long")


def _stars(pairs: DataFrame) -> DataFrame:
    """Cells that compare each ``a`` with its ``b``s, ``STAR_ROWS`` or so at a time."""
    sizes = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    spread = pairs.join(sizes, "a").select(F.col("a").alias("k1"), F.pmod(F.xxhash64("b"), F.expr(f"n div {STAR_ROWS} + 1")).cast("int").alias("k2"), "b")
    members = spread.select("k1", "k2", F.lit(1).alias("side"), F.col("b").alias("cls"))
    centres = spread.select("k1", "k2").distinct().select("k1", "k2", F.lit(0).alias("side"), F.col("k1").alias("cls"))
    return members.unionByName(centres).select("k1", "k2", F.lit(0).alias("k3"), "side", "cls", F.col("cls").alias("comp"))


def _squares(buckets: DataFrame) -> DataFrame:
    """Cells that compare all members (bucket, n, cls, comp) of a bucket: pairs of its blocks."""
    blocks = F.expr(f"cast(n div {BLOCK} + 1 as int)")
    placed = buckets.withColumn("at", F.pmod(F.xxhash64("cls", "bucket"), blocks).cast("int")).withColumn(
        "with", F.explode(F.sequence(F.lit(0), blocks - 1)))
    at, other = F.col("at"), F.col("with")
    return placed.select(F.col("bucket").alias("k1"), F.least(at, other).alias("k2"), F.greatest(at, other).alias("k3"),
                         F.when(at == other, 2).when(at < other, 0).otherwise(1).alias("side"), "cls", "comp")


def _not_ruled_out(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose registers leave a similarity of ``percent`` possible."""
    j = percent / 100
    least = j - MARGIN * (j * (1 - j) / REGISTERS) ** 0.5

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in ("ra", "rb"))
                keep = likely_similarity(left, right, batch.column("na").to_numpy(), batch.column("nb").to_numpy()) >= least
                yield batch.select(["a", "b"]).filter(pa.array(keep))

    side = lambda x: classes.select(F.col("cls").alias(x), F.col("registers").alias("r" + x), F.col("n_shingles").alias("n" + x))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ra", "rb", "na", "nb").mapInArrow(run, "a long, b long")


def near_components(docs: DataFrame, width: int = WIDTH, percent: int = MIN_PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    plain = document_columns(docs)
    signed = staged(sign(plain, width), "signed")
    classes = staged(signed.where("n_shingles > 0 and doc_id is not null").groupBy("cls").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers")), "classes")
    links = staged(_class_links(plain, classes, width, percent), "links")
    labels = components(links)
    named = classes.join(labels, F.col("cls") == F.col("node"), "left").select("cls", "rep", F.coalesce("label", "cls").alias("label"))
    # rows of one id are one node, whatever their sets
    by_id = signed.where("n_shingles > 0 and doc_id is not null").select("doc_id", "cls").distinct().groupBy("doc_id").agg(
        F.min("cls").alias("one"), F.max("cls").alias("other")).where("one <> other")
    if not by_id.isEmpty():
        same_id = signed.where("n_shingles > 0").join(by_id.select("doc_id", "one"), "doc_id").select(F.col("one").alias("a"), F.col("cls").alias("b"))
        labels = components(links.unionByName(same_id))
        named = classes.join(labels, F.col("cls") == F.col("node"), "left").select("cls", "rep", F.coalesce("label", "cls").alias("label"))
    named = staged(named, "named")
    least = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    found = named.join(least, "label").select("cls", "component_id")
    linked = F.when(F.col("n_shingles") > 0, F.col("component_id"))
    return (signed.select("doc_id", "n_shingles", "cls").join(found, "cls", "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce(linked, "doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def _class_links(docs: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between classes, enough of them to have the right components."""
    bands = _bands(classes)
    shared = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    members = staged(bands.join(shared, "bucket"), "members")
    ids = members.select("cls").distinct().join(classes.select("cls", "rep"), "cls")
    texts = staged(_texts(docs, ids, width), "texts")
    sizes = classes.select("cls", "n_shingles")
    counted = members.join(sizes, "cls").join(_own_shingles(texts, width), "cls", "left").withColumn("own", F.coalesce("own", F.lit(0)))
    members = staged(_able(counted, percent).select("bucket", "cls", "n_shingles", "own"), "members")

    centre = F.min_by(F.struct("cls", "n_shingles", "own"), F.struct(F.col("own") / F.col("n_shingles"), "cls"))
    centres = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), centre.alias("c")).where("n > 1").select(
        "bucket", F.col("c.cls").alias("a"), F.col("c.n_shingles").alias("na"), F.col("c.own").alias("oa"))
    first = (members.join(centres, "bucket").where("cls <> a").select("a", "na", "oa", F.col("cls").alias("b"), F.col("n_shingles").alias("nb"), F.col("own").alias("ob"))
             .where(_possible(percent)).select("a", "b").distinct())
    found = staged(_links(_stars(first), texts, width, percent), "links")

    labels = components(found)
    placed = staged(members.join(labels, F.col("cls") == F.col("node"), "left").select(
        "bucket", "cls", "n_shingles", "own", F.coalesce("label", "cls").alias("comp")), "placed")
    mixed_ = placed.groupBy("bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high")
    open_ = staged(_able(placed.join(mixed_.select("bucket"), "bucket"), percent), "open")
    sizes = open_.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high")
    rest = staged(open_.join(sizes.select("bucket", "n"), "bucket"), "rest")
    small, large = rest.where(F.col("n") <= SMALL_BUCKET), rest.where(F.col("n") > SMALL_BUCKET)
    side = lambda x: small.select("bucket", F.col("cls").alias(x), F.col("comp").alias("c" + x), F.col("n_shingles").alias("n" + x), F.col("own").alias("o" + x))
    pairs = (side("a").join(side("b"), "bucket").where((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & _possible(percent))
             .select("a", "b").distinct())
    more = _links(_stars(staged(_not_ruled_out(pairs, classes, percent), "pairs")), texts, width, percent)
    return found.unionByName(more).unionByName(_links(_squares(large), texts, width, percent))


def _able(members: DataFrame, percent: int) -> DataFrame:
    """The members that their bucket's smallest set, or one of the least size that can be similar, leaves a chance."""
    low = members.groupBy("bucket").agg(F.min("n_shingles").alias("least"))
    partner = F.greatest(100 * F.col("least"), percent * F.col("n_shingles"))
    enough = 100 * (100 + percent) * (F.col("n_shingles") - F.col("own")) >= percent * (100 * F.col("n_shingles") + partner)
    return members.join(low, "bucket").where(enough).drop("least")


def _possible(percent: int):
    """Whether sets of sizes na, nb with oa, ob shingles of their own can be similar enough."""
    both = F.least(F.col("na") - F.col("oa"), F.col("nb") - F.col("ob"))
    return (100 + percent) * both >= percent * (F.col("na") + F.col("nb"))


def op3_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(table(spark, sf_dir, "documents"), percent=MIN_PERCENT)


SQL = r"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (select distinct doc_id, array_to_string(w[i:i + 4], ' ') as g from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from d where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by 1),
k as (select g from s group by g having count(*) > 1),
p as (select a.doc_id as x, b.doc_id as y, count(*) as inter from s a join s b on a.g = b.g and a.doc_id < b.doc_id where a.g in (select g from k) group by 1, 2),
l as (select x, y from p join n a on a.doc_id = x join n b on b.doc_id = y where 100 * inter >= 85 * (a.n + b.n - inter)),
e as (select x, y from l union all select y, x from l),
r as (select x as doc_id, x as c from e union select e.x, r.c from e join r on r.doc_id = e.y),
m as (select doc_id, min(c) as c from r group by 1)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, coalesce(m.c, d.doc_id) as component_id, coalesce(m.c, d.doc_id) = d.doc_id as kept
from d left join n on n.doc_id = d.doc_id left join m on m.doc_id = d.doc_id"""
