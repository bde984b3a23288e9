"""Jaccard join of shingle sets by partition enumeration.

Sets of a and b shingles whose similarity is at least 3/4 differ in at most
(a + b) / 7 of them. The 64-bit domain of shingle hashes is cut into
`DENSITY` times as many partitions as a size band allows shingles. A difference
spoils one partition, so that similar sets agree wholly on all others: the
signatures of a set are the hashes of what it has in each single partition that
it occupies (the subsets enumerated are of one partition, which at this
similarity gives the fewest signatures), and similar sets of one band share at
least `need` = occupied partitions - greatest difference of them.

Bands double in size. A set files signatures under its own band, and under the
next one if a similar set can be that large. Sets of up to `SINGLES` shingles
have one partition for each shingle, and so have, among themselves, the few
larger sets that occupy too few partitions.

Signatures held by 2 to `WIDE` sets give candidate pairs. Signatures of more
sets are wide and give none: a set with fewer wide signatures than `need`
shares another signature with each similar set. The sets that are left, whose
text is nearly all frequent, fall into families that share wide signatures.
In each family some pivots are compared with every member, several times;
then members outside the largest component are compared with all members, in
blocks. So nothing is capped, and no group's pairs are listed.

Equal sets are one node. Lower-case is that of A-Z. Null and empty texts have
no shingles and are linked with nothing; a text of 1 to 4 words has one
shingle. Repeated rows and ids get the answer of their text; null ids are
larger than all others. Empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stardw.llm.components import components
from stardw.llm.tables import in_tasks, spread_join, stored, unused
from stardw.llm.words import Words, give_back, mix, run_sums, slices, tidy

DENSITY = 0.4
SINGLES = 16
WIDE = 24
FLUSH = 1 << 18
SLICE = 1 << 18
GROUP_BYTES = 1 << 25
PIVOTS = 16
ROUNDS = 2
BLOCK = 1024
BITS = 1 << 23
BANDS = 64
REST = BANDS - 1

_U = np.uint64
_ENTRY = np.dtype([("sig", "<u8"), ("node", "<u8")])


def _sets(part: pa.RecordBatch, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes, where each row's begin, sizes, and a 64-bit hash of each row's set."""
    words = Words(part.column(text), lower=True)
    row, value = words.shingles()
    first = np.searchsorted(row, np.arange(part.num_rows + 1))
    size = np.diff(first)
    return value, first, size, mix(run_sums(mix(value), first) + size.astype(_U))


def nodes(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row `key`, `n_shingles`, `node`, a hash of its set, and `print`, a hash of its text."""
    rows = documents.select(
        F.col(key).cast("long").alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("print"))
    return with_nodes(rows, "node", "n_shingles").drop("text")


def _band(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each size's band and the largest size of that band."""
    band = np.ceil(np.log2(np.maximum(size, 1) / SINGLES)).astype(np.int64).clip(0)
    return band, (SINGLES << band).astype(np.int64)


def _gather(first: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the shingles of `rows`, and for each the number of its row in `rows`."""
    size = first[rows + 1] - first[rows]
    which = np.repeat(np.arange(len(rows)), size)
    start = np.cumsum(size) - size
    return np.arange(size.sum()) - start[which] + first[rows][which], which


def _singles(value, first, rows, node, band) -> np.ndarray:
    at, which = _gather(first, rows)
    out = np.empty(len(at), _ENTRY)
    code = mix(value[at] + _U(0x5851F42D4C957F2D))
    out["sig"] = (code & _U(2**64 - BANDS)) | _U(band)
    out["node"] = node[rows][which]
    return out


def signatures(
    value: np.ndarray, first: np.ndarray, size: np.ndarray, node: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Entries (signature, node), and for each set and band it files under node, band and `need`."""
    own, top = _band(size)
    reach = 4 * size // 3
    rows = np.arange(len(size))
    rows = np.concatenate([rows[size > 0], rows[(size > 0) & (reach > top)]])
    band = own[rows].copy()
    band[int((size > 0).sum()):] += 1
    largest = (SINGLES << band).astype(np.int64)
    differ = (size[rows] + np.minimum(largest, reach[rows])) // 7
    need = np.zeros(len(rows), np.int64)
    entries = []

    small = band == 0
    entries.append(_singles(value, first, rows[small], node, 0))
    need[small] = size[rows[small]] - differ[small]

    big = np.flatnonzero(~small)
    at, which = _gather(first, rows[big])
    parts = (DENSITY * largest[big]).astype(np.int64)
    offset = np.cumsum(parts) - parts
    place = offset[which] + (((value[at] >> _U(32)) * parts[which].astype(_U)) >> _U(32)).astype(np.int64)
    total = int(parts.sum())
    sums, held = np.zeros(total, _U), np.bincount(place, minlength=total)
    np.add.at(sums, place, mix(value[at] + _U(0x14057B7EF767814F)))
    full = np.flatnonzero(held)
    owner = np.searchsorted(offset, full, "right") - 1
    out = np.empty(len(full), _ENTRY)
    code = mix(sums[full] + band[big][owner].astype(_U))
    out["sig"] = (code & _U(2**64 - BANDS)) | band[big][owner].astype(_U)
    out["node"] = node[rows[big]][owner]
    entries.append(out)
    need[big] = np.bincount(owner, minlength=len(big)) - differ[big]

    rest = np.unique(rows[need <= 0])
    entries.append(_singles(value, first, rest, node, REST))
    need = np.maximum(need, 1)
    node_of, bands = node[rows], band
    if len(rest):
        node_of, bands = np.concatenate([node_of, node[rest]]), np.concatenate([bands, np.full(len(rest), REST)])
        need = np.concatenate([need, size[rest] - (size[rest] + reach[rest]) // 7])
    return np.concatenate(entries), node_of, bands, need


def _views(column: pa.Array | pa.ChunkedArray) -> Iterator[np.ndarray]:
    """The 64-bit numbers in each binary value, which are not copied."""
    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        if len(chunk):
            chunk = chunk.cast(pa.large_binary())
            _, offsets, data = chunk.buffers()
            at = np.frombuffer(offsets, np.int64)[chunk.offset:chunk.offset + len(chunk) + 1]
            values = np.frombuffer(data or b"", np.uint8)
            for low, high in zip(at[:-1], at[1:], strict=True):
                yield values[low:high].view(_U)


def _runs(sig: np.ndarray) -> np.ndarray:
    """Bounds of runs of equal values."""
    return np.concatenate([[0], np.flatnonzero(sig[1:] != sig[:-1]) + 1, [len(sig)]]) if len(sig) else np.zeros(1, int)


def _sorted_unique(entries: np.ndarray) -> np.ndarray:
    entries = entries[np.lexsort((entries["node"], entries["sig"]))]
    keep = np.ones(len(entries), bool)
    keep[1:] = entries[1:] != entries[:-1]
    return entries[keep]


def _shared_only(entries: np.ndarray, also: np.ndarray) -> np.ndarray:
    """Entries whose signature occurs more than once or is in `also`, sorted, without repeats."""
    order = np.argsort(entries["sig"])
    sig = entries["sig"][order]
    more = np.zeros(len(sig), bool)
    more[1:] = sig[1:] == sig[:-1]
    more[:-1] |= more[1:]
    if len(also):
        more |= np.isin(sig, also)
    return _sorted_unique(entries[order[more]])


def _packed(documents: DataFrame, groups: int) -> DataFrame:
    """Entries of all sets in blocks: `part`, `kind`, `data`.

    Kinds: entries; entries known to be wide; wide signatures; needs.
    """
    def blocks(entries: np.ndarray) -> Iterator[tuple[int, str, bytes]]:
        order = np.argsort(entries["sig"])
        sig = entries["sig"][order]
        bounds = _runs(sig)
        long = np.diff(bounds) > WIDE
        if long.any():
            mask = np.repeat(long, np.diff(bounds))
            wide = _sorted_unique(entries[order[mask]])
            entries = entries[order[~mask]]
            runs = _runs(wide["sig"])
            marks = wide["sig"][runs[:-1]]
            yield from dealt(marks, marks, "mark")
            yield from dealt(wide, wide["node"], "wide")
        yield from dealt(entries, entries["sig"], "entry")

    def dealt(items: np.ndarray, by: np.ndarray, kind: str) -> Iterator[tuple[int, str, bytes]]:
        part = ((by >> _U(32)) * _U(groups) >> _U(32)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        part, items = part[order], items[order]
        bounds = _runs(part)
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            yield int(part[low]), kind, items[low:high].tobytes()

    def batch_of(rows: list) -> pa.RecordBatch:
        part, kind, data = zip(*rows, strict=True)
        return pa.RecordBatch.from_pydict({
            "part": pa.array(part, pa.int32()), "kind": pa.array(kind, pa.string()),
            "data": pa.array(data, pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count, seen = [], 0, np.zeros(0, _U)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                value, first, size, node = _sets(part, "text")
                # A set that this task has met already files nothing again.
                new = np.zeros(len(node), bool)
                new[np.unique(node, return_index=True)[1]] = True
                new &= ~np.isin(node, seen)
                seen = np.concatenate([seen, node[new]])
                at, _ = _gather(first, np.flatnonzero(new))
                value, size, node = value[at], size[new], node[new]
                first = np.concatenate([[0], np.cumsum(size)])
                entries, owner, band, need = signatures(value, first, size, node)
                needs = np.stack([owner, (band.astype(_U) << _U(48)) | need.astype(_U)], axis=1)
                rows = list(dealt(needs, owner, "need"))
                if rows:
                    yield batch_of(rows)
                held.append(entries)
                count += len(entries)
                if count >= FLUSH:
                    yield batch_of(list(blocks(np.concatenate(held))))
                    held, count = [], 0
        if count:
            yield batch_of(list(blocks(np.concatenate(held))))

    return documents.select("text").mapInArrow(tidy(run), "part int, kind string, data binary")


def shared(documents: DataFrame, groups: int) -> DataFrame:
    """What the signatures tell: `kind` pair (nodes a and b, band and number
    of signatures shared), wide (signature, node) or need (node, band, need)."""
    def find(table: pa.Table) -> pa.Table:
        blocks: dict[str, list[np.ndarray]] = {k: [np.zeros(0, _U)] for k in ("entry", "mark", "wide", "need")}
        for kind, data in zip(table.column("kind").to_pylist(), _views(table.column("data")), strict=True):
            blocks[kind].append(data)
        marks = np.unique(np.concatenate(blocks["mark"]))
        wide = np.concatenate(blocks["wide"]).view(_ENTRY)
        needs = np.unique(np.concatenate(blocks["need"]).reshape(-1, 2), axis=0)
        entries = _shared_only(np.concatenate(blocks["entry"]).view(_ENTRY), marks)
        bounds = _runs(entries["sig"])
        length = np.repeat(np.diff(bounds), np.diff(bounds))
        many = length > WIDE
        if len(marks):
            many |= np.isin(entries["sig"], marks)
        wide = np.concatenate([wide, entries[many]])
        few = entries[~many]
        pairs = []
        for step in range(1, WIDE):
            both = np.flatnonzero(few["sig"][step:] == few["sig"][:-step]) if len(few) > step else []
            if not len(both):
                break
            pairs.append(np.stack(
                [few["node"][both], few["node"][both + step], few["sig"][both] & _U(BANDS - 1)], axis=1))
        found = np.concatenate(pairs) if pairs else np.zeros((0, 3), _U)
        found, times = np.unique(found, axis=0, return_counts=True)
        times = times.astype(_U) | (found[:, 2] << _U(48))
        a = np.concatenate([found[:, 0], wide["sig"], needs[:, 0]])
        b = np.concatenate([found[:, 1], wide["node"], needs[:, 1] >> _U(48)])
        c = np.concatenate([times, np.zeros(len(wide), _U), needs[:, 1] & _U(2**48 - 1)])
        kind = np.repeat(np.array(["pair", "wide", "need"]), [len(found), len(wide), len(needs)])
        return pa.table({"kind": pa.array(kind, pa.string()), "a": pa.array(a.view(np.int64)),
                         "b": pa.array(b.view(np.int64)), "c": pa.array(c.view(np.int64))})

    def tidied(table: pa.Table) -> pa.Table:
        found = find(table)
        give_back()
        return found

    return _packed(documents, groups).groupBy("part").applyInArrow(tidied, "kind string, a bigint, b bigint, c bigint")


def candidates(tells: DataFrame) -> DataFrame:
    """Pairs of nodes that share as many signatures as similar sets must; wide ones count for both."""
    load, number = F.shiftright("c", 48).alias("band"), F.col("c").bitwiseAND((1 << 48) - 1)
    pairs = (
        tells.filter("kind = 'pair'").groupBy("a", "b", load).agg(F.sum(number).alias("shared"))
    )
    needs = needed(tells)
    for side in ("a", "b"):
        pairs = pairs.join(needs.select(
            F.col("node").alias(side), "band", F.col("need").alias(f"need_{side}"), F.col("wide").alias(f"wide_{side}")
        ), [side, "band"])
    enough = F.col("shared") + F.least("wide_a", "wide_b") >= F.greatest("need_a", "need_b")
    return pairs.filter(enough).select("a", "b").distinct()


def needed(tells: DataFrame) -> DataFrame:
    """Per node and band: `need` and `wide`, the number of its wide signatures."""
    wide = (
        tells.filter("kind = 'wide'")
        .groupBy(F.col("b").alias("node"), F.col("a").bitwiseAND(BANDS - 1).alias("band"))
        .agg(F.count("*").alias("wide"))
    )
    needs = tells.filter("kind = 'need'").select(
        F.col("a").alias("node"), F.col("b").alias("band"), F.col("c").alias("need")
    ).distinct()
    return needs.join(wide, ["node", "band"], "left").withColumn("wide", F.coalesce("wide", F.lit(0)))


def shingle_sets(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """(`node`, `shingles`: sorted 64-bit hashes as bytes) of the nodes in `wanted`.

    A bitmap of fixed size holds which nodes may be wanted, so that only their
    sets leave the tasks that read the texts.
    """
    spots = wanted.select((F.pmod("node", F.lit(BITS)) + 1).alias("spot"))
    maps = spots.groupBy(F.bitmap_bucket_number("spot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bits")
    ).collect()  # at most BITS bits
    bits = np.zeros(BITS, bool)
    for row in maps:
        some = np.unpackbits(np.frombuffer(bytes(row["bits"]), np.uint8), bitorder="little")
        bits[(row["bucket"] - 1) * len(some) + np.flatnonzero(some)] = True
    packed = np.packbits(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask, seen = np.unpackbits(packed).astype(bool), set()
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                value, first, size, node = _sets(part, "text")
                keys, sets = [], []
                for i in np.flatnonzero((size > 0) & mask[(node % _U(BITS)).astype(np.int64)]):
                    if node[i] not in seen:
                        seen.add(node[i])
                        keys.append(int(node[i].astype(np.int64)))
                        sets.append(np.sort(value[first[i]:first[i + 1]]).tobytes())
                yield pa.RecordBatch.from_pydict(
                    {"node": pa.array(keys, pa.int64()), "shingles": pa.array(sets, pa.binary())})

    found = documents.select("text").mapInArrow(tidy(run), "node bigint, shingles binary")
    return found.join(wanted, "node", "left_semi").dropDuplicates(["node"])


def similar(a: bytes | np.ndarray, b: bytes | np.ndarray) -> bool:
    x, y = np.frombuffer(a, _U), np.frombuffer(b, _U)
    if 4 * min(len(x), len(y)) < 3 * max(len(x), len(y)):
        return False
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    both = int((y[at] == x).sum())
    return 100 * both >= 75 * (len(x) + len(y) - both)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (`a`, `b`) whose sets are similar."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(_views(batch.column("x")), _views(batch.column("y")), strict=True)
            keep = pa.array([similar(p, q) for p, q in both], pa.bool_())
            yield batch.select(["a", "b"]).filter(keep)

    side = {c: sets.select(F.col("node").alias(c), F.col("shingles").alias(s)) for c, s in (("a", "x"), ("b", "y"))}
    return pairs.join(side["a"], "a").join(side["b"], "b").select("a", "b", "x", "y").mapInArrow(tidy(run), "a bigint, b bigint")


def _compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Similar pairs of a member in `left` and a query in `right`."""
    members = [np.frombuffer(s, _U) for s in left["shingles"]]
    out = []
    if members and len(right):
        size = np.array([len(m) for m in members])
        every, owner = np.concatenate(members), np.repeat(np.arange(len(members)), size)
        order = np.argsort(every, kind="stable")
        every, owner = every[order], owner[order]
        names = left["node"].to_numpy()
        for node, data in zip(right["node"], right["shingles"], strict=True):
            query = np.frombuffer(data, _U)
            low, high = np.searchsorted(every, query), np.searchsorted(every, query, "right")
            n = high - low
            at = np.arange(n.sum()) + np.repeat(low - (np.cumsum(n) - n), n)
            both = np.bincount(owner[at], minlength=len(members))
            hits = np.flatnonzero((100 * both >= 75 * (size + len(query) - both)) & (names != node))
            out += [(int(names[i]), int(node)) for i in hits]
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def _blocks(family: DataFrame, queries: DataFrame) -> DataFrame:
    """Links between `queries` and all members of their families (`root`, `node`, `shingles`)."""
    ways = family.groupBy("root").agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("ways"))
    asked = queries.groupBy("root").agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("asks"))
    size = ways.join(asked, "root")

    def dealt(rows: DataFrame, own: str, other: str, own_name: str, other_name: str) -> DataFrame:
        return rows.join(size, "root").select(
            "root", "node", "shingles", F.pmod(F.xxhash64("node"), F.col(own)).alias(own_name),
            F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias(other_name),
        )

    members = dealt(family, "ways", "asks", "block", "ask")
    # Other names, as both sides come from one table.
    asking = dealt(queries, "asks", "ways", "ask", "block").toDF("of", "asked", "wanted", "asks", "blocks")

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _compare(left, right.rename(columns={"asked": "node", "wanted": "shingles"}))

    return members.groupBy("root", "block", "ask").cogroup(asking.groupBy("of", "blocks", "asks")).applyInPandas(
        compare, "a bigint, b bigint"
    )


def families(tells: DataFrame) -> DataFrame:
    """(`node`, `root`, `share`) of the sets that may share nothing but wide signatures with a similar one."""
    deep = needed(tells).filter("wide >= need").select("node", "band", (F.col("wide") / F.col("need")).alias("share"))
    wide = tells.filter("kind = 'wide'").select(
        F.col("a").alias("sig"), F.col("b").alias("node"), F.col("a").bitwiseAND(BANDS - 1).alias("band")
    ).join(deep, ["node", "band"])
    low = wide.groupBy("sig").agg(F.min("node").alias("low"), F.count("*").alias("n")).filter("n > 1")
    ends = stored(
        wide.join(low, "sig").filter("node <> low").select(F.col("node").alias("a"), F.col("low").alias("b")).distinct(),
        "op5-ends",
    )
    best = deep.groupBy("node").agg(F.max("share").alias("share"))
    return components(ends).join(best, "node")


def deep_links(family: DataFrame) -> DataFrame | None:
    """All links that matter among the members of families (`root`, `node`, `share`, `shingles`).

    Pivots are the members with the most frequent text that are not yet in
    their family's largest component. Links inside that component change nothing.
    """
    left, links, n = family, None, family.count()
    for turn in range(ROUNDS + 1):
        if turn < ROUNDS:
            order = Window.partitionBy("root").orderBy(F.desc("share"), "node")
            queries = left.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= PIVOTS).drop("_rank")
        else:
            queries = left
        found = _blocks(family, queries.select("root", "node", "shingles"))
        links = stored(found if links is None else found.unionByName(links).distinct(), "op5-deep")
        grouped = family.select("root", "node").join(
            components(links).select("node", F.col("root").alias("group")), "node", "left"
        ).withColumn("group", F.coalesce("group", "node"))
        grouped = stored(in_tasks(grouped, n), "op5-grouped")
        sizes = grouped.groupBy("root", "group").count()
        largest = sizes.groupBy("root").agg(F.max(F.struct("count", "group")).alias("m")).select("root", "m.group")
        rest = grouped.join(largest, ["root", "group"], "left_anti").select("node")
        left = stored(in_tasks(family.join(rest, "node", "left_semi"), n), "op5-left")
        if left.isEmpty():
            break
    return links


def classes(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row `key`, `n_shingles` and `component`, the smallest key reachable by links.

    Also `node`, the row's set, `print`, its text, and `best`, the set of the row with that smallest key.
    """
    rows = stored(nodes(documents, key, text), "op5-nodes")
    total, shingles = rows.agg(F.count("*"), F.sum("n_shingles")).first()
    texts = documents.select(F.col(text).alias("text"))
    groups = max(1, (shingles or 0) * 11 // GROUP_BYTES)
    tells = stored(shared(texts, groups), "op5-shared")
    pairs = stored(candidates(tells), "op5-pairs")
    family = stored(families(tells), "op5-families")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).unionByName(family.select("node")).distinct()
    sets = stored(shingle_sets(texts, stored(wanted, "op5-wanted")), "op5-sets")
    links = verified(pairs, sets)
    if not family.isEmpty():
        links = links.unionByName(deep_links(stored(family.join(sets, "node"), "op5-members")))
    roots = components(links)
    first = rows.filter("n_shingles > 0").groupBy("node").agg(F.min("key").alias("first"), F.count("*").alias("n"))
    placed = first.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = stored(placed, "op5-placed")
    best = F.min(F.struct(F.col("first").isNull().alias("none"), "first", "node")).alias("best")
    lowest = placed.groupBy("root").agg(best, F.count("*").alias("members")).select(
        "root", F.col("best.first").alias("component"), F.col("best.node").alias("best"), "members"
    )
    named = spread_join(placed, lowest, "root", "members", total).select("node", "component", "best", "n")
    known = spread_join(rows.filter("n_shingles > 0"), stored(named, "op5-named"), "node", "n", total)
    alone = rows.filter("n_shingles = 0").withColumn("component", F.col("key")).withColumn("best", F.col("node"))
    columns = ["key", "n_shingles", "component", "node", "print", "best"]
    return known.select(*columns).unionByName(alone.select(*columns))


def keep_one(documents: DataFrame) -> DataFrame:
    """One row of `documents` for each group of linked rows, that with the smallest id.

    Texts without shingles are linked with nothing and stay; of rows that share
    both the smallest id and the set of shingles one stays.
    """
    p = unused(documents)
    judged = stored(classes(documents), "op5-classes")
    linked = judged.filter("n_shingles > 0")
    stays = F.col("key").eqNullSafe(F.col("component")) & (F.col("node") == F.col("best"))
    names = [F.col(c).alias(f"{p}{c}") for c in ("key", "print", "node")]
    # Rows are known again by id and hash of the text, so that no text passes through Python once more.
    same = F.col("doc_id").eqNullSafe(F.col(f"{p}key")) & (F.xxhash64("text") == F.col(f"{p}print"))
    kept = documents.join(linked.filter(~stays).select(*names[:2]).distinct(), same, "left_anti")
    best = linked.filter(stays)
    twice = stored(best.groupBy("key", "node").count().filter("count > 1").select("key", "node"), "op5-twice")
    if twice.isEmpty():
        return kept
    again = best.select(*names).distinct().join(
        twice, F.col(f"{p}key").eqNullSafe(F.col("key")) & (F.col(f"{p}node") == F.col("node")), "left_semi")
    once = kept.join(again, same, "left_anti")
    return once.unionByName(
        kept.join(again, same).dropDuplicates(["doc_id", f"{p}node"]).select(*[F.col(f"`{c}`") for c in documents.columns]))


def with_nodes(documents: DataFrame, node: str, size: str, text: str = "text") -> DataFrame:
    """`documents` with the hash of each row's set and the size of the set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, SLICE):
                _, _, n, name = _sets(part, text)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(name.view(np.int64)), pa.array(n.astype(np.int64))],
                    [*part.schema.names, node, size])

    fields = [T.StructField(node, T.LongType()), T.StructField(size, T.LongType())]
    return documents.mapInArrow(tidy(run), T.StructType([*documents.schema.fields, *fields]))
