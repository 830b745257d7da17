"""How far the sources of a language are apart, and which terms set each of them off.

1. **Chunks.** Texts are cut at ASCII white space, which no term holds. Each document's chunks are
   counted where it lies. A task packs what it knows of a chunk in a lang into one row: a record (document,
   source, occurrences) per document, or, once as many documents as the support asks for hold it,
   a record per source. Texts are read once and never shuffled.
2. **Factorisation.** The rows meet by chunk; each globally distinct chunk is cut into terms once, and
   its records go on under each of its terms.
3. **Terms.** The records meet by term. Two chunks of one document may hold the same term, so documents
   are counted distinctly, unless a chunk had enough of them by itself. Kept terms leave one row each:
   the sources that have them, and their occurrences there.
4. **Smoothed shares** of all kept terms in each (lang, source) group and each lang, in whole billionths.
5. **Divergence of pairs of sources.** A term that a source lacks has the same share there as any other that
   it lacks, so only terms that both have need looking at together: tiles of sources add these up inside
   tasks. Terms of one of the two go through a histogram of its shares; the rest is a product.

Sorted partitions are read as streams, some ten thousand rows at a time, so memory does not grow with them.
All arithmetic is on whole numbers; the products that could pass 64 bits are decimals.

Defined cases: null text, lang and source are empty ones; a row is a document, whatever its id, so a row met twice is
two documents; groups without terms take part with counts of 0; ties go by the bytes of the item;
texts of any length are read whole (a task holds the distinct chunks of one text); other columns take no part, whatever
they are called; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mailsift import session
from mailsift.llm.common import Work, flat_text, steps, text_bytes

SUPPORT = 10  # documents of a lang that a kept term is in
TOP = 10
SCALE = 1_000_000_000
FLUSH = 2_500_000  # records a task holds before it hands them on
SPAN = 20_000  # rows of a sorted partition that a task looks at together
TILE = 256  # sources along a side of a tile
TILES = 64  # tiles a task holds before it hands them on
CELLS = 1 << 18  # cells of the terms and pairs that are added up at a time
# Terms are what is left between ASCII characters other than letters; only A-Z are lower-cased.
_LETTERS = bytes(b if b >= 0x80 or chr(b).isalpha() or b == 0x0A else 0x20 for b in range(256))
# Occurrences in one document; or, without a document, in as many as were asked for or more.
_RECORD = np.dtype([("row", "<i8"), ("place", "<i4"), ("occurrences", "<i8")])
_MANY = -1


def terms_of(chunks: list[bytes]) -> list[list[bytes]]:
    """The terms of every chunk; chunks hold no white space."""
    if not chunks:
        return []
    return [line.split() for line in b"\n".join(chunks).lower().translate(_LETTERS).split(b"\n")]


def _offsets(lengths: np.ndarray, kind) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)]).astype(kind)


def _packed(records: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Records of consecutive owners, as one binary value each."""
    offsets = _offsets(lengths * _RECORD.itemsize, np.int64)
    data = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(records))]
    )
    return data.cast(pa.binary())


def _by_source(owner: np.ndarray, records: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Records summed by owner and source, without their documents."""
    order = np.lexsort((records["place"], owner))
    owner, records = owner[order], records[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (records["place"][1:] != records["place"][:-1])
    first = np.flatnonzero(new)
    out = records[first].copy()
    out["row"] = _MANY
    out["occurrences"] = np.add.reduceat(records["occurrences"], first) if len(first) else 0
    return owner[first], out


def _shortened(owner: np.ndarray, records: np.ndarray, n: int, support: int) -> tuple[np.ndarray, np.ndarray]:
    """Records ordered by owner (0 to n - 1); those of owners with enough documents are summed by source."""
    docs = np.bincount(owner, records["row"] != _MANY, n)
    many = docs >= support
    many[owner[records["row"] == _MANY]] = True
    whole = many[owner]
    owners, sums = _by_source(owner[whole], records[whole])
    owner, records = np.concatenate([owner[~whole], owners]), np.concatenate([records[~whole], sums])
    order = np.argsort(owner, kind="stable")
    return owner[order], records[order]


class _Chunks:
    """The chunks of one lang that a task has met, and a record for every document and chunk."""

    def __init__(self):
        self.places: dict[bytes, int] = {}
        self.chunk: list[int] = []
        self.occurrences: list[int] = []
        self.docs: list[tuple[int, int, int]] = []  # row, source, distinct chunks

    def add(self, text: bytes, row: int, place: int) -> int:
        found, places = Counter(text.split()), self.places
        self.chunk.extend([places.setdefault(chunk, len(places)) for chunk in found])
        self.occurrences.extend(found.values())
        self.docs.append((row, place, len(found)))
        return len(found)

    def batches(self, lang: int, support: int) -> Iterator[pa.RecordBatch]:
        docs = np.array(self.docs, np.int64).reshape(-1, 3)
        records = np.empty(len(self.chunk), _RECORD)
        records["row"], records["place"] = (np.repeat(docs[:, k], docs[:, 2]) for k in (0, 1))
        records["occurrences"] = self.occurrences
        owner, records = _shortened(np.array(self.chunk, np.int64), records, len(self.places), support)
        lengths = np.bincount(owner, minlength=len(self.places))
        chunks = list(self.places)
        at = _offsets(lengths, np.int64)
        for k in range(0, len(chunks), SPAN):
            part = chunks[k : k + SPAN]
            end = k + len(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(part), lang, np.int32)), pa.array(part, pa.binary()),
                 _packed(records[at[k] : at[end]], lengths[k:end])],
                ["lang_no", "chunk", "records"],
            )


def _count_chunks(support: int, flush: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs: dict[int, _Chunks] = {}
        held = 0
        for batch in steps(batches, "text"):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for text, lang, place, row in zip(texts, *(batch.column(c).to_pylist() for c in ("lang_no", "place", "row"))):
                held += langs.setdefault(lang, _Chunks()).add(text, row, place)
                if held > flush:
                    for no, chunks in langs.items():
                        yield from chunks.batches(no, support)
                    langs, held = {}, 0
        for no, chunks in langs.items():
            yield from chunks.batches(no, support)

    return run


def _spans(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows (lang_no, name, records) of a sorted partition, about ``size`` at a time; a name's rows stay together."""
    held: list[pa.RecordBatch] = []
    rows = used = 0
    for batch in batches:
        held.append(batch)
        rows, used = rows + batch.num_rows, used + batch.nbytes
        if rows >= size or used >= 32 << 20:
            names = batch.column(1)
            # A name that fills the whole last batch may have begun before it.
            same = pc.equal(names, names[len(names) - 1]).to_numpy(zero_copy_only=False)
            cut = len(names) - int(same[::-1].argmin()) if not same.all() else 0
            if cut:
                yield pa.concat_batches([*held[:-1], batch.slice(0, cut)])
                held = [batch.slice(cut)]
                rows, used = held[0].num_rows, held[0].nbytes
    if held:
        yield pa.concat_batches(held)


def _changes(column: pa.Array) -> np.ndarray:
    """Where a value is not the one before it; true for the first."""
    new = np.ones(len(column), bool)
    new[1:] = pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    return new


def _owned(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First rows of the groups of equal (lang_no, name), and all records with their groups."""
    new = _changes(rows.column(0)) | _changes(rows.column(1))
    flat, at = flat_text(rows.column(2))
    lengths = np.diff(at) // _RECORD.itemsize
    return np.flatnonzero(new), np.repeat(np.cumsum(new) - 1, lengths), np.frombuffer(flat.tobytes(), _RECORD)


def _cut_chunks(support: int, span: int):
    """Rows by chunk to rows by term; each distinct chunk is cut once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _spans(batches, span):
            first, owner, records = _owned(rows)
            owner, records = _shortened(owner, records, len(first), support)
            lengths = np.bincount(owner, minlength=len(first))
            chunks = rows.column(1).take(pa.array(first))
            new = _changes(chunks)
            cut = terms_of(chunks.filter(pa.array(new)).cast(pa.binary()).to_pylist())
            of = (np.cumsum(new) - 1).tolist()  # of every group, its chunk among the distinct ones
            groups, terms, often = [], [], []
            for group, i in enumerate(of):
                mine = cut[i]
                if len(mine) == 1:
                    groups.append(group)
                    terms.append(mine[0])
                elif mine:
                    found = Counter(mine)
                    groups += [group] * len(found)
                    if len(found) < len(mine):
                        often += [(len(terms) + k, n) for k, n in enumerate(found.values()) if n > 1]
                    terms += found
            if not terms:
                continue
            packed = _packed(records, lengths).take(pa.array(groups))
            if often:
                changed = dict(often)
                values = packed.to_pylist()
                for k, n in changed.items():
                    more = np.frombuffer(values[k], _RECORD).copy()
                    more["occurrences"] *= n
                    values[k] = more.tobytes()
                packed = pa.array(values, pa.binary())
            langs = rows.column(0).take(pa.array(first[groups]))
            yield pa.RecordBatch.from_arrays([langs, pa.array(terms, pa.binary()), packed], ["lang_no", "term", "records"])

    return run


def _kept_terms(support: int, span: int):
    """Rows by term to one row per kept term: its sources and its occurrences in each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _spans(batches, span):
            first, owner, records = _owned(rows)
            known = records["row"] != _MANY
            pairs = np.empty(int(known.sum()), [("owner", np.int64), ("row", np.int64)])
            pairs["owner"], pairs["row"] = owner[known], records["row"][known]
            kept = np.bincount(np.unique(pairs)["owner"], minlength=len(first)) >= support
            kept[owner[~known]] = True
            mine = kept[owner]
            owner, records = _by_source(owner[mine], records[mine])
            lengths = np.bincount(owner, minlength=len(first))[kept]
            if not len(lengths):
                continue
            offsets = _offsets(lengths, np.int32)
            lists = [
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(records[c])))
                for c in ("place", "occurrences")
            ]
            chosen = pa.array(first[kept])
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).take(chosen), rows.column(1).take(chosen), *lists], ["lang_no", "term", "places", "counts"]
            )

    return run


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)), exactly."""
    whole = F.lit(SCALE).cast("decimal(10,0)") * (count + 2).cast("decimal(19,0)")
    return F.when(terms > 0, F.call_function("div", whole, (total + 2 * terms).cast("decimal(20,0)")) + 1).otherwise(F.lit(0).cast("long"))


def _apart(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); shares are below 2^31, so the square fits 64 bits."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _tile_sums(side: int, most: int):
    """For terms that two sources both have: how far they are apart there, less what it were if either, or both, had it not."""

    def f(p, q):
        return (p - q) ** 2 // (p + q)

    def out(sums) -> Iterator[pa.RecordBatch]:
        for (lang, a, b), tile in sums.items():
            i, j = np.nonzero(tile)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), lang, np.int32)), pa.array((i + a * side).astype(np.int32)),
                 pa.array((j + b * side).astype(np.int32)), pa.array(tile[i, j])],
                ["lang_no", "place", "other_place", "value"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, np.ndarray] = {}
        for batch in batches:
            langs = batch.column("lang_no").to_numpy(zero_copy_only=False)
            found = batch.column("found")
            lengths = found.value_lengths().to_numpy(zero_copy_only=False)
            entries = found.flatten()
            place, p, p0 = (entries.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3))
            term = np.repeat(np.arange(len(langs)), lengths)
            for lang in np.unique(langs):
                here = langs[term] == lang
                for key, tile in tiles(term[here], place[here], p[here], p0[here]):
                    if (lang, *key) not in sums:
                        if len(sums) >= most:
                            yield from out(sums)
                            sums.clear()
                        sums[lang, *key] = np.zeros((side, side), np.int64)
                    sums[lang, *key] += tile
        yield from out(sums)

    def tiles(term, place, p, p0):
        """Tiles (block, block), each summed over these terms. A source without a term gets the same
        share with and without it, any, and so adds nothing."""
        block = place // side
        for a in np.unique(block):
            for b in np.unique(block[block >= a]):
                tile = np.zeros((side, side), np.int64)
                both = np.intersect1d(term[block == a], term[block == b])
                rows = {x: (np.isin(term, both) & (block == x)) for x in {a, b}}
                width = {x: np.unique(place[rows[x]] - x * side) for x in rows}
                step = max(1, CELLS // max(1, len(width[a]) * len(width[b])))
                for k in range(0, len(both), step):
                    part = both[k : k + step]
                    dense = {}
                    for x in rows:
                        mine = rows[x] & (term >= part[0]) & (term <= part[-1])
                        cells = np.searchsorted(part, term[mine]), np.searchsorted(width[x], place[mine] - x * side)
                        dense[x] = np.ones((2, len(part), len(width[x])), np.int64)
                        dense[x][0][cells], dense[x][1][cells] = p[mine], p0[mine]
                    (pa_, qa), (pb, qb) = dense[a][:, :, :, None], dense[b][:, :, None, :]
                    more = (f(pa_, pb) - f(pa_, qb) - f(qa, pb) + f(qa, qb)).sum(0)
                    tile[np.ix_(width[a], width[b])] += more
                yield (a, b), np.triu(tile, 1) if a == b else tile

    return run


class Audit:
    """Tables of the audit: ``groups`` and ``terms`` (kept ones), ``pairs()`` and ``telling()``."""

    def __init__(self, docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                 support: int = SUPPORT, flush: int = FLUSH, span: int = SPAN, tile: int = TILE):
        if support < 1:
            raise ValueError("support must be 1 at least")
        session.tune(docs.sparkSession)
        self.work = work = Work(docs.sparkSession)
        self.tile = tile
        named = docs.select(
            text_bytes(lang_col).alias("lang"), text_bytes(source_col).alias("source"), text_bytes(text_col).alias("text")
        )
        groups = self._numbered(work, named)
        # Joined by broadcast while Spark finds the groups small; whatever their number, the result is the same.
        rows = named.join(groups, ["lang", "source"]).select(
            "lang_no", "place", "text", F.monotonically_increasing_id().alias("row")
        )
        by_chunk = (
            rows.mapInArrow(_count_chunks(support, flush), "lang_no int, chunk binary, records binary")
            .repartition(F.col("chunk")).sortWithinPartitions("chunk", "lang_no")
        )
        by_term = (
            by_chunk.mapInArrow(_cut_chunks(support, span), "lang_no int, term binary, records binary")
            .repartition(F.col("term")).sortWithinPartitions("term", "lang_no")
        )
        kept = by_term.mapInArrow(_kept_terms(support, span), "lang_no int, term binary, places array<int>, counts array<long>")
        kept = work.keep(kept.withColumn("term", F.col("term").cast("string")))
        whole = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)
        sizes = kept.groupBy("lang_no").agg(F.count("*").alias("terms"), F.sum(whole).alias("lang_total"))
        each = kept.select("lang_no", F.explode(F.arrays_zip("places", "counts")).alias("x"))
        totals = each.groupBy("lang_no", F.col("x.places").alias("place")).agg(F.sum("x.counts").alias("total"))
        nothing = F.lit(0).cast("long")
        groups = groups.join(sizes, "lang_no", "left").join(totals, ["lang_no", "place"], "left")
        groups = groups.na.fill(0, ["terms", "lang_total", "total"])
        self.groups = work.keep(groups.withColumn("p0", _share(nothing, F.col("total"), F.col("terms"))))
        # One row per lang, its sources in order.
        langs = self.groups.groupBy("lang_no", "terms", "lang_total").agg(
            F.array_sort(F.collect_list(F.struct("place", "total", "p0"))).alias("sources")
        )
        source = lambda place, field: F.get(F.col("sources"), place)[field]
        shares = F.transform(
            F.arrays_zip("places", "counts"),
            lambda x: F.struct(
                x["places"].alias("place"), x["counts"].alias("count"),
                _share(x["counts"], source(x["places"], "total"), F.col("terms")).alias("p"), source(x["places"], "p0").alias("p0"),
            ),
        )
        self.terms = kept.join(langs, "lang_no").select(
            "lang_no", "term", _share(whole, F.col("lang_total"), F.col("terms")).alias("q"), shares.alias("found")
        )

    @staticmethod
    def _numbered(work: Work, named: DataFrame) -> DataFrame:
        """Groups with a number for their lang and their source's place in it."""
        groups = work.keep(named.select("lang", "source").distinct())
        langs = groups.select("lang").distinct().withColumn("lang_no", F.row_number().over(Window.orderBy("lang")))
        place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
        return work.keep(groups.join(langs, "lang").withColumn("place", place))

    def telling(self, top: int = TOP) -> DataFrame:
        """The terms that set a source off from its lang most: lang, source, term, value, rank."""
        each = self.terms.select("lang_no", "term", "q", F.explode("found").alias("x"))
        value = _apart(F.col("x.p"), F.col("q")).alias("value")
        found = each.where("x.p > q").select("lang_no", F.col("x.place").alias("place"), "term", value)
        ranked = Window.partitionBy("lang_no", "place").orderBy(F.desc("value"), "term")
        best = found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
        names = self.groups.select("lang_no", "place", "lang", "source")
        return best.join(names, ["lang_no", "place"]).select("lang", "source", "term", "value", "rank")

    def pairs(self) -> DataFrame:
        """Every two sources of a lang: lang, source, other, value, rank of the other for the source."""
        groups = self.groups.select("lang_no", "lang", "source", "place", "p0", "terms")
        keys = ["lang_no", "place", "other_place"]
        both = (
            self.terms.where(F.size("found") > 1)
            .select("lang_no", F.transform("found", lambda x: F.struct(x["place"], x["p"], x["p0"])).alias("found"))
            .mapInArrow(_tile_sums(self.tile, TILES), "lang_no int, place int, other_place int, value long")
            .groupBy(*keys).agg(F.sum("value").alias("both"))  # place < other_place
        )
        both = both.unionByName(_turned(both, "both", "both"))
        others = groups.select(
            "lang_no", F.col("source").alias("other"), F.col("place").alias("other_place"), F.col("p0").alias("other_p0")
        )
        shares = self.terms.select("lang_no", F.explode("found").alias("x")).groupBy("lang_no", "x.place", "x.p", "x.p0")
        alone = (
            shares.agg(F.count("*").alias("times")).join(others, "lang_no").where("place != other_place")
            .groupBy(*keys)
            .agg(F.sum(F.col("times") * (_apart(F.col("p"), F.col("other_p0")) - _apart(F.col("p0"), F.col("other_p0")))).alias("alone"))
        )
        alone = self.work.keep(alone)
        zero = F.when(F.col("terms") > 0, F.col("terms") * _apart(F.col("p0"), F.col("other_p0"))).otherwise(0)
        found = (
            groups.join(others, "lang_no").where("place != other_place")
            .join(both, keys, "left").join(alone, keys, "left").join(_turned(alone, "alone", "back"), keys, "left")
            .na.fill(0, ["both", "alone", "back"])
            .select("lang", "source", "other", (zero + F.col("both") + F.col("alone") + F.col("back")).cast("long").alias("value"))
        )
        ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "other")
        return found.withColumn("rank", F.row_number().over(ranked))


def _turned(sums: DataFrame, name: str, as_name: str) -> DataFrame:
    return sums.select(
        "lang_no", F.col("other_place").alias("place"), F.col("place").alias("other_place"), F.col(name).alias(as_name)
    )
