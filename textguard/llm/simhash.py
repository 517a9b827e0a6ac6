"""SimHash near-dedup by pigeonring filtering.

Fingerprint: majority bits of the XXH64 values (seed 42) of a text's word
shingles. Two fingerprints link when they differ in at most ``max_bits`` bits.

Pigeonring: cut the 64 bits into m = max_bits + 1 segments laid on a ring. If
two fingerprints differ in t bits or fewer, some segment starts a chain whose
first j segments differ in at most floor(j * t / m) bits together, for every j
up to m. The first ``chain`` segments of that condition become the join key:
a probe row is written for every pattern that stays within the budgets, an
index row for the value itself. The budgets of the remaining prefixes prune the
candidates before the full Hamming check.

Scale: only distinct fingerprints are linked (copies share one). Keys with up
to HOT index rows are joined as plain rows; a hotter key is cut into blocks of
about BLOCK rows and every pair of blocks is one small group, which returns a
spanning forest of its links and so never all pairs. Components come from
``graph.components``, in written rounds. Nothing is collected to the driver
but counts.

Defined results: null and wordless texts have fingerprint zero and are linked
like any other; a null doc_id takes part, and is a component's id only if no
member has one; repeated rows each return a row; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textguard.llm.common import pin
from textguard.llm.graph import components

#: Index rows that a key may have to be joined as plain rows.
HOT = 128
#: Fingerprints in a block of a hotter key.
BLOCK = 1024
#: Hashes that are unpacked to bits at a time.
SLICE = 1 << 16


def fingerprint(data: bytes, shingle: int = 4) -> int:
    """64-bit SimHash of UTF-8 ``data``: ASCII letters lower-cased, words cut
    at ASCII white space, shingles joined by one space, repeats counted."""
    words = data.lower().split()
    if not words:
        return 0
    text = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    spans = map(slice, starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
    hashes = np.frombuffer(b"".join(map(xxhash.xxh64_digest, map(text.__getitem__, spans), repeat(42))), np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), SLICE):
        ones += np.unpackbits(hashes[i : i + SLICE], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 4, out: str = "fp") -> DataFrame:
    """``docs`` without its text, with the fingerprint as a signed long."""
    carried = [c for c in docs.columns if c != text]
    schema = T.StructType([f for f in docs.schema if f.name != text] + [T.StructField(out, T.LongType())])

    def run(batches):
        for b in batches:
            texts = b.column(b.schema.get_field_index(text)).cast(pa.binary())
            fp = np.array([fingerprint(x.as_buffer().to_pybytes(), shingle) if x.is_valid else 0 for x in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in carried), pa.array(fp)], names=[*carried, out])

    return docs.mapInArrow(run, schema)


# --------------------------------------------------------------------------- the ring
def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def ring_masks(max_bits: int) -> list[int]:
    """Bit masks of the m = max_bits + 1 segments, as even as can be."""
    m = max_bits + 1
    edges = [round(i * 64 / m) for i in range(m + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]


def budgets(max_bits: int) -> list[int]:
    """Differences allowed in the first j segments of a chain, j = 1 .. m."""
    return [j * max_bits // (max_bits + 1) for j in range(1, max_bits + 2)]


def prefix_masks(max_bits: int, start: int) -> list[int]:
    """Masks of the chain's first 1 .. m segments from ``start`` on."""
    seg, out = ring_masks(max_bits), []
    for j in range(len(seg)):
        out.append((out[-1] if out else 0) | seg[(start + j) % len(seg)])
    return out


def patterns(max_bits: int, start: int, chain: int) -> list[int]:
    """Every difference within the budgets of the chain's first segments."""
    prefixes, allowed = prefix_masks(max_bits, start)[:chain], budgets(max_bits)[:chain]
    bits = [1 << i for i in range(64) if prefixes[-1] >> i & 1]
    found = [sum(c) for k in range(allowed[-1] + 1) for c in combinations(bits, k)]
    return [x for x in found if all((x & p).bit_count() <= a for p, a in zip(prefixes, allowed))]


def _by_start(max_bits: int, pick) -> "F.Column":
    """CASE on the chain's start, for values that differ by it."""
    col = F.lit(None)
    for i in range(max_bits + 1):
        col = F.when(F.col("start") == i, pick(i)).otherwise(col)
    return col


def _chain_length(n: int, max_bits: int) -> int:
    """Segments in the key: as many as make it selective for n fingerprints."""
    bits = 64 // (max_bits + 1)
    return next((c for c in range(2, max_bits + 1) if n >> (bits * c) < 64), max_bits) if max_bits else 1


def _block_links(max_bits: int):
    """Links between the index and the probe rows of one pair of blocks, as a
    spanning forest: at most one row for each fingerprint."""
    prefix = [prefix_masks(max_bits, i) for i in range(max_bits + 1)]
    allowed = budgets(max_bits)

    def run(pdf):
        import pandas as pd

        index, probe = (np.unique(pdf["fp"].to_numpy()[pdf["probe"].to_numpy() == s].view(np.uint64)) for s in (False, True))
        masks = prefix[int(pdf["start"].iloc[0])]
        a, b = [], []
        near = np.zeros((len(index), len(probe)), bool)
        for i, x in enumerate(index):
            d = x ^ probe
            ok = np.ones(len(probe), bool)
            for p, k in zip(masks, allowed):
                ok &= np.bitwise_count(d & np.uint64(p)) <= k
            near[i] = ok  # the last prefix is the whole ring: the full Hamming check
        left, right = np.ones(len(index), bool), np.ones(len(probe), bool)
        while left.any():
            front = [(0, int(np.flatnonzero(left)[0]))]
            left[front[0][1]] = False
            while front:
                side, i = front.pop()
                new = np.flatnonzero(near[i] & right) if side == 0 else np.flatnonzero(near[:, i] & left)
                (right if side == 0 else left)[new] = False
                here = index[i] if side == 0 else probe[i]
                for j in new.tolist():
                    there = probe[j] if side == 0 else index[j]
                    if here != there:
                        a.append(here)
                        b.append(there)
                    front.append((1 - side, j))
        a, b = (np.array(v, np.uint64).view(np.int64) for v in (a, b))
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return run


def links(fps: DataFrame, max_bits: int = 4) -> DataFrame:
    """Edges (a, b), a < b, that connect the same fingerprints as all pairs
    within ``max_bits`` do. ``fps``: distinct, pinned values in column ``fp``."""
    starts = max_bits + 1
    chain = _chain_length(fps.count(), max_bits)
    key = [prefix_masks(max_bits, i)[chain - 1] for i in range(starts)]
    side = lambda rows: F.explode(F.array(*(F.struct(F.lit(i).alias("start"), v.alias("key")) for i, v in rows)))
    index = fps.select("fp", side((i, F.col("fp").bitwiseAND(F.lit(_signed(key[i])))) for i in range(starts)).alias("k")).select("fp", "k.start", "k.key")
    flips = F.array(*(F.array(*(F.lit(_signed(p)) for p in patterns(max_bits, i, chain))) for i in range(starts)))
    masks = F.array(*(F.lit(_signed(k)) for k in key))
    probe = (
        fps.select("fp", F.posexplode(flips).alias("start", "flips"))
        .select("fp", "start", F.explode("flips").alias("flip"))
        .select("fp", "start", F.col("fp").bitwiseXOR(F.col("flip")).bitwiseAND(F.get(masks, F.col("start"))).alias("key"))
    )
    sizes = index.groupBy("start", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT)
    hot = pin(sizes, "simhash-hot")
    plain = index if hot.isEmpty() else index.join(hot.select("start", "key"), ["start", "key"], "left_anti")
    d = F.col("fp").bitwiseXOR(F.col("other"))
    within = F.lit(True)
    for j in range(chain, starts):
        mask = _by_start(max_bits, lambda i, j=j: F.lit(_signed(prefix_masks(max_bits, i)[j])))
        within = within & (F.bit_count(d.bitwiseAND(mask)) <= budgets(max_bits)[j])
    pairs = probe.join(plain.withColumnRenamed("fp", "other"), ["start", "key"]).filter((F.col("fp") < F.col("other")) & within)
    pairs = pairs.select(F.col("fp").alias("a"), F.col("other").alias("b"))
    if not hot.isEmpty():
        # Rows of hot keys: as many blocks as the key's rows on that side ask for.
        p = pin(probe.join(hot.select("start", "key"), ["start", "key"]), "simhash-hot-probes")
        counts = hot.join(p.groupBy("start", "key").agg(F.count(F.lit(1)).alias("np")), ["start", "key"]).select(
            "start", "key", F.ceil(F.col("n") / BLOCK).cast("int").alias("bi"), F.ceil(F.col("np") / BLOCK).cast("int").alias("bp")
        )
        counts = pin(counts, "simhash-hot-blocks")
        here = lambda n: F.pmod(F.xxhash64("fp"), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        rows = index.join(counts, ["start", "key"]).select("start", "key", here("bi").alias("i"), every("bp").alias("p"), "fp", F.lit(False).alias("probe"))
        rows = rows.unionByName(p.join(counts, ["start", "key"]).select("start", "key", every("bi").alias("i"), here("bp").alias("p"), "fp", F.lit(True).alias("probe")))
        pairs = pairs.unionByName(rows.groupBy("start", "key", "i", "p").applyInPandas(_block_links(max_bits), "a long, b long"))
    return pairs.distinct()


def near_duplicates(docs: DataFrame, max_bits: int = 4, shingle: int = 4, key: str = "doc_id", text: str = "text", carry=()) -> DataFrame:
    """One row per document: (key, *carry, fp long, component, root long).

    ``component`` is the smallest key reachable over links, itself included,
    ``root`` the smallest fingerprint of the same group, which tells groups apart
    where a key is null or stands in several. ``carry`` names further columns of
    ``docs`` to return; one called like a column above gets underscores before it.
    """
    named = docs.select(F.struct(F.col(key).alias("key"), *(F.col(c).alias(f"c{i}") for i, c in enumerate(carry))).alias("row"), F.col(text).alias("text"))
    rows = pin(fingerprints(named, "text", shingle), "simhash-rows")
    fps = pin(rows.groupBy("fp").agg(F.min("row.key").alias("least")), "simhash-distinct")
    edges = pin(links(fps.select("fp"), max_bits), "simhash-links")
    member = components(edges)  # (node, root), of linked fingerprints only
    grouped = fps.join(member.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    grouped = pin(grouped, "simhash-groups")
    least = pin(grouped.groupBy("root").agg(F.min("least").alias("component")), "simhash-roots")
    members = pin(grouped.join(least, "root").select("fp", "component", "root"), "simhash-members")
    # Both sides are plain tables: the join may split a fingerprint with very many copies.
    out = rows.join(members, "fp").select(F.col("row.key").alias(key), "row", "fp", "component", "root")
    taken, named = {key.lower(), "fp", "component", "root"}, []
    for i, c in enumerate(carry):
        while c.lower() in taken:
            c = f"_{c}"
        taken.add(c.lower())
        named.append(F.col("row")[f"c{i}"].alias(c))
    return out.select(key, *named, "fp", "component", "root")
