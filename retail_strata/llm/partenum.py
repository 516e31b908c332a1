"""N-gram Jaccard join with PartEnum signatures, and the components of its links.

A document's set holds its distinct word shingles as 64-bit hashes. Two sets link if
``100 * |x & y| >= threshold * |x | y|``. Links are exact up to hash collisions:

* Sizes fall into bands ``[2**i, 2**(i + 1))``. A set takes part in its own band and, if a larger
  partner may be there, in the next.
* Linked sets of sizes a and b differ in at most ``d = floor((a + b)(100 - t) / (100 + t))``
  elements. A band parts the feature domain into ranges of hash values, as many as it takes that
  one of any ``d // 2 + 1`` ranges holds at most one of a pair's differences, for its largest d.
* Each range is parted into three again, and the subsets of two of these parts are enumerated: the
  hash of a set's elements in a subset is a signature. Where a range holds at most one difference,
  one of its subsets holds none, and the pair shares that signature.
* Only subsets that hold an element give signatures. A set goes through its band's ranges in their
  order until it has ``d // 2 + 1`` that hold elements in two parts or more, for its own d: whichever
  of a pair stops first has a range among these with at most one difference, whose subsets all hold
  an element, and the other set gives signatures for that range too.
* A set with too few such ranges takes part in another partition too, with other hash values, and
  so on. In a band whose sets link only if they are equal, the whole set is the signature.

Sets that share a signature are first compared with one of them, its centre (a star, linear in the
group). Where the components of these links still part a group, its other members are compared
across components: in a group of few as pairs, in a larger one block by block within tasks.
Copies are one set throughout, and components are found by distributed steps, so neither a large
group nor a large component meets in one task.

Null texts, empty texts and texts of white space have the empty set and link with nothing; fewer
words than a shingle make one shingle of the whole sequence. Rows are reported as often as they
occur. A null id is kept, and counts for a component only if no other id is there. An empty table
gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_strata.llm.common import (
    U64,
    HashFilter,
    as_long,
    blocks,
    components,
    lean,
    mix,
    stage,
    utf8,
    word_hashes,
)

#: Parts of a range; each subset leaves one out.
PARTS = 3
#: Signatures of a bucket; elements and members of a block of sets to compare.
BUCKET, BLOCK_ELEMENTS, BLOCK_MEMBERS = 1 << 20, 200_000, 512
#: Members of an element from which on they are counted by matrix products.
DENSE = 6
#: Partitions tried for a set with few ranges that are not empty; elements differ, so two are rare.
LEVELS = 16
#: Members up to which the pairs of a group, across components, are candidates one by one.
SMALL = 32
#: The largest count that a sketch can tell.
MOST = 15

_ROW = np.dtype([("sig", "<u8"), ("key", "<u8")])
_NAMES = ["sig", "key", "n", "centre", "centre_n", "size"]
_MEMBERS = ", ".join(f"{name} bigint" for name in _NAMES)


def document_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every row."""
    offsets, data = utf8(column)
    factors = mix(np.arange(1, width + 1, dtype=U64)) | U64(1)
    for first, end in blocks(offsets):
        words, at = word_hashes(offsets[first : end + 1], data[offsets[first] : offsets[end]])
        full = len(words) - width + 1
        if full > 0:
            grams = words[:full] * factors[0]
            for k in range(1, width):
                grams = grams + words[k : k + full] * factors[k]
            grams = mix(grams)
        for a, b in zip(at[:-1], at[1:], strict=True):
            if b - a >= width:
                found = np.sort(grams[a : b - width + 1])
                yield found[np.concatenate([[True], found[1:] != found[:-1]])]
            elif b > a:
                whole = (words[a:b] * factors[: b - a]).sum(dtype=U64) + U64(b - a)
                yield mix(np.array([whole]))
            else:
                yield np.zeros(0, dtype=U64)


def set_key(elements: np.ndarray) -> int:
    """A 64-bit digest of a set that is not empty."""
    total = mix(elements + U64(0x5851F42D4C957F2D)).sum(dtype=U64)
    return int(mix(np.array([total ^ U64(len(elements))]))[0].astype(np.int64))


def most_different(total: int, threshold: int) -> int:
    """Elements in which two linked sets with ``total`` elements together can differ at most."""
    return total * (100 - threshold) // (100 + threshold)


def bands(size: int, threshold: int) -> Iterator[tuple[int, int]]:
    """``(band, d)`` of the bands in which a set takes part."""
    band, largest = size.bit_length() - 1, size * 100 // threshold
    top = (2 << band) - 1
    yield band, most_different(size + min(largest, top), threshold)
    if largest > top:
        yield band + 1, most_different(size + largest, threshold)


def ranges_of(band: int, threshold: int) -> int:
    """Ranges of a band's partition; none if its sets link only if they are equal."""
    top = (2 << band) - 1
    d = most_different(2 * top, threshold)
    return d // 2 + 1 if d else 0


def signatures(elements: np.ndarray, threshold: int) -> Iterator[np.ndarray]:
    """Signatures of one set that is not empty."""
    for band, d in bands(len(elements), threshold):
        n = ranges_of(band, threshold)
        salt = band << 40
        if n == 0:
            yield mix(np.array([mix(elements).sum(dtype=U64) ^ U64(salt)]))
            continue
        values = elements
        for level in range(LEVELS):
            if level:
                values = np.sort(mix(elements + U64(0xD6E8FEB86659FD93 * level % (1 << 64))))
            part = (((values >> U64(32)) * U64(PARTS * n)) >> U64(32)).astype(np.int64)
            starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            contents = np.zeros(PARTS * n, dtype=U64)
            contents[part[starts]] = np.add.reduceat(mix(values), starts)
            held = np.bincount(part, minlength=PARTS * n).reshape(n, PARTS)
            contents = contents.reshape(n, PARTS)
            full = np.cumsum((held > 0).sum(axis=1) >= 2)
            enough = full[-1] > d // 2
            stop = int(np.searchsorted(full, d // 2 + 1)) + 1 if enough else n
            subsets = (contents.sum(axis=1, dtype=U64)[:, None] - contents)[:stop]
            some = (held.sum(axis=1)[:, None] - held)[:stop] > 0
            place = np.arange(PARTS * stop, dtype=U64).reshape(stop, PARTS)
            yield mix(subsets ^ mix(place + U64(salt + (level << 32))))[some]
            if enough:
                break
        else:
            yield mix(np.array([salt + (LEVELS << 32)], dtype=U64))


def describe(docs: DataFrame, width: int, threshold: int) -> DataFrame:
    """``(id, n, key, sigs)`` of every row: its set's size and digest (null if empty), and about how
    many signatures the set has."""
    kind = docs.schema["id"].dataType.simpleString()

    def found(batches):
        for batch in batches:
            sizes, keys, sigs = [], [], []
            for elements in document_sets(batch["text"], width):
                n = len(elements)
                sizes.append(n)
                keys.append(set_key(elements) if n else None)
                sigs.append(sum(PARTS * (d // 2 + 1) for _, d in bands(n, threshold)) if n else 0)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(sizes, pa.int64()), pa.array(keys, pa.int64())]
                + [pa.array(sigs, pa.int64())],
                ["id", "n", "key", "sigs"],
            )

    return docs.mapInArrow(lean(found), f"id {kind}, n bigint, key bigint, sigs bigint")


def group_members(
    docs: DataFrame, first: DataFrame, width: int, threshold: int, buckets: int
) -> DataFrame:
    """``(bucket, sig, key, size)``: members of the signatures that sets share.

    Of the rows that have one set only that in ``first`` (``key, id``) gives its signatures; a
    bitmap finds it, and what else passes is dropped when the groups are made. A map task sends each
    bucket one packed row for all its signatures; a bucket's rows are sorted with numpy.
    """
    spark = docs.sparkSession
    ids = first.select(F.xxhash64("id").alias("id"))
    shared = spark.sparkContext.broadcast(HashFilter.of(ids, "id"))

    def dealt(batches):
        held: list[np.ndarray] = []
        count = 0

        def flush() -> pa.RecordBatch:
            rows = np.concatenate(held)
            at = (rows["sig"] % U64(buckets)).astype(np.int64)
            order = np.lexsort((rows["key"], rows["sig"], at))
            rows, at = rows[order], at[order]
            new = np.ones(len(rows), dtype=bool)  # a copy's rows are the same
            new[1:] = (rows["sig"][1:] != rows["sig"][:-1]) | (rows["key"][1:] != rows["key"][:-1])
            rows, at = rows[new], at[new]
            found, first = np.unique(at, return_index=True)
            last = [*first[1:], len(at)]
            packed = [rows[a:b].tobytes() for a, b in zip(first, last, strict=True)]
            return pa.RecordBatch.from_arrays(
                [pa.array(found, pa.int32()), pa.array(packed, pa.binary())], ["bucket", "packed"]
            )

        for batch in batches:
            named = shared.value.has(batch["id"].to_numpy().view(U64))
            some = batch.filter(pa.array(named, pa.bool_()))
            for elements in document_sets(some["text"], width):
                if not len(elements):
                    continue
                key = np.array([set_key(elements)]).view(U64)[0]
                for found in signatures(elements, threshold):
                    rows = np.empty(len(found), dtype=_ROW)
                    rows["sig"], rows["key"] = found, key
                    held.append(rows)
                    count += len(found)
                if count >= BUCKET:
                    yield flush()
                    held, count = [], 0
        if held:
            yield flush()

    def grouped(table: pa.Table) -> pa.Table:
        rows = np.concatenate([np.frombuffer(x, dtype=_ROW) for x in table["packed"].to_pylist()])
        order = np.lexsort((rows["key"], rows["sig"]))
        rows = rows[order]
        new = np.ones(len(rows), dtype=bool)
        new[1:] = (rows["sig"][1:] != rows["sig"][:-1]) | (rows["key"][1:] != rows["key"][:-1])
        rows = rows[new]
        first = np.flatnonzero(np.concatenate([[True], rows["sig"][1:] != rows["sig"][:-1]]))
        size = np.diff([*first, len(rows)])
        keep = np.repeat(size, size) > 1
        rows = rows[keep]
        return pa.table(
            {
                "bucket": pa.array(np.full(len(rows), table["bucket"][0].as_py()), pa.int32()),
                "sig": as_long(rows["sig"]),
                "key": as_long(rows["key"]),
                "size": pa.array(np.repeat(size, size)[keep], pa.int64()),
            }
        )

    return (
        docs.select(F.xxhash64("id").alias("id"), "text")
        .mapInArrow(lean(dealt), "bucket int, packed binary")
        .groupBy("bucket")
        .applyInArrow(grouped, "bucket int, sig bigint, key bigint, size bigint")
    )


def with_centres(members: DataFrame, first: DataFrame) -> DataFrame:
    """``(sig, key, n, centre, centre_n, size)``: each signature's members with its centre.

    ``first`` has the size ``n`` of each key's set.

    That is the member that shares most signatures with other sets altogether (ties: the least
    key). Near copies of one text share more with that text than with each other, so it is the
    set to compare them with.
    """
    shared = members.groupBy("key").agg(F.sum(F.col("size") - 1).alias("shared"))
    shared = shared.join(first.select("key", "n"), "key")

    def centred(table: pa.Table) -> pa.Table:
        sig, key, n, size, much = (
            table[c].to_numpy() for c in ("sig", "key", "n", "size", "shared")
        )
        order = np.lexsort((key, -much, sig))
        sig, key, n, size = sig[order], key[order], n[order], size[order]
        first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        centre = np.repeat(first, np.diff([*first, len(sig)]))
        columns = (sig, key, n, key[centre], n[centre], size)
        return pa.table([pa.array(c, pa.int64()) for c in columns], _NAMES)

    return members.join(shared, "key").groupBy("bucket").applyInArrow(centred, _MEMBERS)


def sketch(elements: np.ndarray) -> bytes:
    """How many elements lie in each of as many ranges as there are elements, in four bits each."""
    bits = max(4, len(elements).bit_length() - 1)
    counts = np.bincount((elements >> U64(64 - bits)).astype(np.int64), minlength=1 << bits)
    counts = np.minimum(counts, MOST).astype(np.uint8)
    return (counts[::2] | (counts[1::2] << 4)).tobytes()


def may_link(x: bytes, y: bytes, m: int, n: int, threshold: int) -> bool:
    """Whether sets of these sketches and sizes can share enough: in no range more than both have."""
    a, b = (np.frombuffer(z, dtype=np.uint8) for z in (x, y))
    a, b = (np.stack([z & MOST, z >> 4], axis=1).reshape(-1) for z in (a, b))
    if (a == MOST).any() or (b == MOST).any():  # such a range may hold any number
        return True
    if len(a) > len(b):
        a, b = b, a
    if len(a) < len(b):
        b = b.reshape(len(a), -1).sum(axis=1)
    most = int(np.minimum(a, b).sum())
    return 100 * most >= threshold * (m + n - most)


def sets_of(
    docs: DataFrame, first: DataFrame, keys: DataFrame, width: int, sketched: bool = False
) -> DataFrame:
    """``(key, elements)`` of the sets with the given keys, packed; or the sketches of them.

    A set is taken from the row named in ``first`` (``key, id``), and once by a task. The bitmaps
    that find these rows may let a copy pass, which repeats a set and changes no link.
    """
    context = docs.sparkSession.sparkContext
    ids = first.join(keys, "key").select(F.xxhash64("id").alias("id"))
    wanted = context.broadcast((HashFilter.of(keys, "key"), HashFilter.of(ids, "id")))

    def found(batches):
        by_key, by_id = wanted.value
        sent: set[int] = set()
        for batch in batches:
            named = by_id.has(batch["id"].to_numpy().view(U64))
            some = batch.filter(pa.array(named, pa.bool_()))
            sets: dict[int, bytes] = {}
            for elements in document_sets(some["text"], width):
                if len(elements):
                    key = set_key(elements)
                    if key not in sent and by_key.has(np.array([key]).view(U64))[0]:
                        sets[key] = sketch(elements) if sketched else elements.tobytes()
                        sent.add(key)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sets), pa.int64()), pa.array(list(sets.values()), pa.binary())],
                ["key", "elements"],
            )

    return docs.select(F.xxhash64("id").alias("id"), "text").mapInArrow(
        lean(found), "key bigint, elements binary"
    )


def alike(a, b, threshold: int):
    """Whether sets of two sizes can link at all."""
    return (100 * F.least(a, b)) >= (threshold * F.greatest(a, b))


def star_pairs(members: DataFrame, threshold: int) -> DataFrame:
    """``(u, v, m, n)``: the centre of each group with every other, and their sizes."""
    pairs = members.where(F.col("key") != F.col("centre")).where(
        alike(F.col("n"), F.col("centre_n"), threshold)
    )
    return pairs.select(
        F.col("centre").alias("u"), F.col("key").alias("v"), F.col("centre_n").alias("m"), "n"
    ).distinct()


def small_group_pairs(rooted: DataFrame, threshold: int) -> DataFrame:
    """Pairs across components of groups with ``SMALL`` members at most, the centres left out.

    Signatures with the very same members count as one. A pair may come up more than once.
    """
    small = rooted.where(F.col("size") <= SMALL)
    of_sig = small.groupBy("sig").agg(
        F.min("root").alias("low"),
        F.max("root").alias("high"),
        F.bit_xor(F.xxhash64("key")).alias("members"),
        F.sum(F.xxhash64("key", F.lit(2)) % (1 << 40)).alias("more"),
    )
    once = of_sig.where("low <> high").groupBy("members", "more").agg(F.min("sig").alias("sig"))
    some = small.where("key <> centre").join(once.select("sig"), "sig").select("sig", "key", "root", "n")

    def pairs_of(rows: np.ndarray) -> pa.RecordBatch:
        """Pairs among rows whose equal signatures follow on each other."""
        sig, key, root, n = rows
        found = [np.zeros((4, 0), dtype=np.int64)]
        for d in range(1, len(sig)):
            i = np.flatnonzero(sig[d:] == sig[:-d])
            if not len(i):  # groups are stretches, so none reaches further
                break
            j = i + d
            near = 100 * np.minimum(n[i], n[j]) >= threshold * np.maximum(n[i], n[j])
            keep = near & (root[i] != root[j])
            i, j = i[keep], j[keep]
            i, j = np.where(key[i] < key[j], i, j), np.where(key[i] < key[j], j, i)
            found.append(np.stack([key[i], key[j], n[i], n[j]]))
        pairs = np.unique(np.concatenate(found, axis=1), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in pairs], ["u", "v", "m", "n"])

    def paired(batches):
        held = np.zeros((4, 0), dtype=np.int64)
        for batch in batches:
            own = np.stack([batch[c].to_numpy() for c in ("sig", "key", "root", "n")])
            held = np.concatenate([held, own], axis=1)
            last = int(np.searchsorted(held[0], held[0][-1])) if held.size else 0
            if last:  # the last group may go on in the next batch
                yield pairs_of(held[:, :last])
                held = held[:, last:]
        yield pairs_of(held)

    return (
        some.repartition("sig")
        .sortWithinPartitions("sig")
        .mapInArrow(lean(paired), "u bigint, v bigint, m bigint, n bigint")
        .distinct()
    )


def beside(pairs: DataFrame, sets: DataFrame, *carried: str) -> DataFrame:
    """Pairs ``(u, v)`` with what ``sets`` holds of either, as ``x`` and ``y``."""
    left = sets.select(F.col("key").alias("u"), F.col("elements").alias("x"))
    right = sets.select(F.col("key").alias("v"), F.col("elements").alias("y"))
    return pairs.join(left, "u").join(right, "v").select("u", "v", "x", "y", *carried)


def possible_pairs(pairs: DataFrame, sketches: DataFrame, threshold: int) -> DataFrame:
    """The pairs ``(u, v)`` whose sketches allow a link; most that do not link are settled here."""

    def possible(batches):
        for batch in batches:
            values = zip(*(batch[c].to_pylist() for c in ("x", "y", "m", "n")), strict=True)
            keep = [may_link(x, y, m, n, threshold) for x, y, m, n in values]
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    found = beside(pairs, sketches, "m", "n").mapInArrow(lean(possible), "u bigint, v bigint")
    return found.distinct()


def verify_pairs(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs ``(u, v)`` that link."""

    def linked(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch["x"].to_pylist(), batch["y"].to_pylist(), strict=True):
                x, y = np.frombuffer(x, dtype=U64), np.frombuffer(y, dtype=U64)
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                keep.append(100 * both >= threshold * (len(x) + len(y) - both))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return beside(pairs, sets).mapInArrow(lean(linked), "u bigint, v bigint").distinct()


def ends_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("u").alias("key")).union(pairs.select("v")).distinct()


def compare_members(
    sets: list[np.ndarray], roots: np.ndarray, sides: np.ndarray, both: bool, threshold: int
) -> list[tuple[int, int]]:
    """Links between members with different roots, one for each two roots that meet.

    ``both``: members of either side are compared among each other as well; else across sides.
    """
    sizes = np.array([len(s) for s in sets])
    m = len(sets)
    elements = np.concatenate(sets)
    order = np.argsort(elements, kind="stable")
    elements, member = elements[order], np.repeat(np.arange(m), sizes)[order]
    first = np.flatnonzero(np.concatenate([[True], elements[1:] != elements[:-1]]))
    times = np.diff([*first, len(elements)])
    common = np.zeros((m, m), dtype=np.float32)
    for t in range(2, DENSE):  # elements of few members: count their pairs
        who = member[first[times == t][:, None] + np.arange(t)]
        for j in range(1, t):
            for i in range(j):  # members are in order, so i < j
                pairs = np.bincount(who[:, i] * m + who[:, j], minlength=m * m)
                common += pairs.reshape(m, m)
    often = np.flatnonzero(times >= DENSE)
    for c in range(0, len(often), 2048):
        some = often[c : c + 2048]
        column = np.repeat(np.arange(len(some)), times[some])
        place = np.repeat(first[some], times[some]) + (
            np.arange(len(column)) - np.repeat(np.cumsum(times[some]) - times[some], times[some])
        )
        table = np.zeros((m, len(some)), dtype=np.float32)
        table[member[place], column] = 1
        common += table @ table.T
    total = sizes[:, None] + sizes[None, :] - common
    linked = 100 * common >= threshold * total
    linked &= roots[:, None] != roots[None, :]
    if not both:
        linked &= sides[:, None] != sides[None, :]
    i, j = np.nonzero(np.triu(linked))
    pairs = np.unique(np.sort(np.stack([roots[i], roots[j]]), axis=0), axis=1)
    return forest(pairs)


def forest(pairs: np.ndarray) -> list[tuple[int, int]]:
    """As many of the pairs as it takes to connect what they connect."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for u, v in pairs.T.tolist():
        a, b = top(u), top(v)
        if a != b:
            parent[max(a, b)] = min(a, b)
            kept.append((u, v))
    return kept


def open_groups(rooted: DataFrame) -> DataFrame:
    """``(group, key, root, n)``: members of larger groups that several components share.

    Groups with the same centre are one, so that a set they share is sent around once; that set
    has been compared with every member already.
    """
    large = rooted.where(F.col("size") > SMALL)
    parted = (
        large.groupBy("sig")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"))
        .where("low <> high")
        .select("sig")
    )
    return (
        large.where("key <> centre")
        .join(parted, "sig")
        .select(F.col("centre").alias("group"), "key", "root", "n")
        .distinct()
    )


def verify_groups(groups: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Links ``(u, v)`` between components, among the members of groups.

    A group's members are dealt to blocks by the sizes of their sets; every two blocks (and every
    block by itself) are one task's work, and no pair of members becomes a row.
    """
    parts = groups.groupBy("group").agg(
        F.greatest(
            F.ceil(F.sum("n") / BLOCK_ELEMENTS), F.ceil(F.count("*") / BLOCK_MEMBERS)
        ).cast("int").alias("parts")
    )
    dealt = (
        groups.join(parts, "group")
        .withColumn("own", F.pmod(F.xxhash64("key", F.lit(1)), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "group",
            "key",
            "root",
            F.least("own", "other").alias("a"),
            F.greatest("own", "other").alias("b"),
            "own",
        )
    )

    def compared(table: pa.Table) -> pa.Table:
        packed = [np.frombuffer(x, dtype=U64) for x in table["elements"].to_pylist()]
        a, b = table["a"][0].as_py(), table["b"][0].as_py()
        links = compare_members(
            packed, table["root"].to_numpy(), table["own"].to_numpy(), a == b, threshold
        )
        u, v = zip(*links, strict=True) if links else ((), ())
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    joined = dealt.join(sets, "key")
    return joined.groupBy("group", "a", "b").applyInArrow(compared, "u bigint, v bigint")


def jaccard_components(
    df: DataFrame, id_column: str, text: str, width: int = 5, threshold: int = 80
) -> DataFrame:
    """``(id, n_shingles, component_id)`` for every row, by the links between the rows' sets."""
    docs = df.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    rows = stage(describe(docs, width, threshold), "described")
    once = rows.where("key is not null").groupBy("key")
    first = stage(once.agg(*[F.min(c).alias(c) for c in ("id", "n", "sigs")]), "first")
    total = first.agg(F.sum("sigs")).first()[0] or 0
    members = stage(
        group_members(docs, first, width, threshold, max(1, total // BUCKET)), "shared-signatures"
    )
    members = stage(with_centres(members, first), "members")
    keys = stage(members.select("key").distinct(), "keys")
    sketches = stage(sets_of(docs, first, keys, width, sketched=True), "sketches")

    def full_sets(keys: DataFrame, name: str) -> DataFrame:
        return stage(sets_of(docs, first, stage(keys, f"keys-{name}"), width), f"sets-{name}")

    pairs = stage(possible_pairs(star_pairs(members, threshold), sketches, threshold), "stars")
    sets = full_sets(ends_of(pairs), "stars")
    links = stage(verify_pairs(pairs, sets, threshold), "links")
    roots = components(links).withColumnRenamed("node", "key")
    rooted = stage(
        members.where("size > 2")
        .join(roots, "key", "left")
        .withColumn("root", F.coalesce("root", "key")),
        "rooted",
    )
    pairs = small_group_pairs(rooted, threshold)
    pairs = stage(possible_pairs(pairs, sketches, threshold), "pairs-small")
    groups = stage(open_groups(rooted), "groups")
    sets = full_sets(ends_of(pairs).union(groups.select("key")).distinct(), "across")
    small = stage(verify_pairs(pairs, sets, threshold), "links-small")
    large = stage(verify_groups(groups, sets, threshold), "links-large")
    roots = components(links.unionByName(small).unionByName(large))
    named = first.select("key", F.col("id").alias("least_id")).join(
        roots.withColumnRenamed("node", "key"), "key", "left"
    )
    named = named.withColumn("root", F.coalesce("root", "key"))
    ids = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_key = named.join(ids, "root").select("key", "component_id")
    return rows.join(by_key, "key", "left").select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "id").alias("component_id"),
    )
