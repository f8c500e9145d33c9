"""Near-duplicates by SimHash and meet-in-the-middle ball hashing (operator 1)."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellwatt.llm.common import documents, give_back, giving_back, LOWER_BYTES, pieces, stored, table, utf8, word_lists
from tellwatt.llm.components import components

SEED = 42
CELL_ROWS = 16384


def sketches(docs: DataFrame, shingle: int = 3, bits: int = 64, tables: int = 1) -> DataFrame:
    """``doc_id`` and ``prints``, an array of ``tables`` fingerprints of ``bits`` bits each.

    ASCII letters are lower-cased, words are runs of anything but ASCII white space,
    and repeated shingles count as often as they occur. A text with fewer words than
    a shingle is one shingle; a null or wordless text has fingerprints zero. Bits
    beyond the 64 of a shingle's hash come from mixing that hash with a constant.
    """
    return docs.select("doc_id", "text").mapInArrow(
        _sketcher(shingle, bits, tables), "doc_id long, prints array<long>"
    )


def _sketcher(shingle: int, bits: int, tables: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from xxhash import xxh64_intdigest

        rounds = -(-bits * tables // 64)
        # A round's hashes: the first as they are, others after a 64-bit finaliser.
        salts = np.arange(rounds, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        mix, low, high = np.uint64(0xD6E8FEB86659FD93), np.uint64(32), np.uint64(29)
        weights = np.uint64(1) << np.arange(bits, dtype=np.uint64)

        def hashes(grams):
            return np.fromiter((xxh64_intdigest(g, SEED) for g in grams), np.uint64, len(grams))

        def counts(plain):
            sums = []
            for k in range(rounds):
                h = plain
                if k:
                    h = (h ^ salts[k]) * mix
                    h = (h ^ (h >> low)) * mix
                    h ^= h >> high
                sums.append(np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64))
            return np.concatenate(sums)

        def prints(text):
            total, seen, last = np.zeros(rounds * 64, np.int64), 0, []
            for words in word_lists((text or b"").translate(LOWER_BYTES)):
                last += words
                grams = [b" ".join(g) for g in zip(*(last[i:] for i in range(shingle)))]
                if grams:
                    made = hashes(grams)
                    for at in range(0, len(made), 1 << 15):
                        total += counts(made[at:at + (1 << 15)])
                    seen += len(made)
                    last = last[len(grams):]
            if not seen and last:
                total, seen = counts(hashes([b" ".join(last)])), 1
            set_bits = (total * 2 > seen)[: bits * tables].reshape(tables, bits)
            return (set_bits * weights).sum(1, dtype=np.uint64).view(np.int64)

        for part in pieces(batches):
            made = [prints(t) for t in utf8(part.column(1))]
            flat = pa.array(np.concatenate(made))
            offsets = pa.array(np.arange(len(made) + 1, dtype=np.int32) * tables)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(offsets, flat)], ["doc_id", "prints"])

    return giving_back(run)


def links(nodes: DataFrame, bits: int) -> DataFrame:
    """Links ``a``, ``b`` between ``node`` rows that have a print within three bits.

    Half of three bits is one bit for one side and two for the other. Every print
    emits all variants within one bit; those with an even number of bits also emit
    their variants at two, as prints three bits apart never agree in parity. So
    whoever shares a variant, with one side within one bit of it, is a true pair,
    and every true pair shares one. All that meet at a variant are linked to the
    smallest node among those within one bit: each node gets one link there, not one
    per pair.

    The shuffle deals out the variants by their first bits: a print is sent once to
    each first part that its variants have, and its variants are formed there. Their
    number is chosen so that a cell holds about ``CELL_ROWS`` prints, which bounds
    what a task holds at any size.
    """
    prints = nodes.select("node", F.posexplode("prints").alias("t", "v"))
    n = nodes.count()
    prefix = max(4, min(24, bits - 8, (max(1, n) // CELL_ROWS).bit_length()))
    low = bits - prefix

    def flips(k: int) -> Column:
        return F.array(*[
            F.struct(F.lit(sum(1 << i for i in c)).cast("long").alias("mask"), F.lit(k).alias("k"))
            for c in combinations(range(prefix), k)
        ])

    reach = F.when(F.bit_count("v") % 2 == 0, F.concat(flips(0), flips(1), flips(2))).otherwise(
        F.concat(flips(0), flips(1))
    )
    first = F.shiftrightunsigned("v", low)
    dealt = prints.select("node", "t", "v", F.explode(reach).alias("f")).select(
        "node",
        F.col("v").bitwiseAND((1 << low) - 1).alias("low"),
        (F.bit_count("v") % 2 == 0).alias("even"),
        F.col("f.k").alias("k"),
        "t",
        first.bitwiseXOR(F.col("f.mask")).alias("cell"),
    )
    return dealt.groupBy("t", "cell").applyInPandas(_meeting(low), "a long, b long").distinct()


def _meeting(low: int):
    def variants(frame):
        """Variants within one bit, whose rows they are, by node within a variant, and where each variant begins."""
        import numpy as np

        node = frame["node"].to_numpy(np.int64)
        part = frame["low"].to_numpy(np.int64).view(np.uint64)
        k = frame["k"].to_numpy()
        ones = np.uint64(1) << np.arange(low, dtype=np.uint64)
        here, near = np.flatnonzero(k == 0), np.flatnonzero(k == 1)
        keys = np.concatenate([part[here], (part[here][:, None] ^ ones).ravel(), part[near]])
        owner = np.concatenate([here, np.repeat(here, low), near])
        order = np.lexsort((node[owner], keys))
        keys, owner = keys[order], owner[order]
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
        return keys, owner, starts

    def visits(frame, unique):
        """Places in ``unique`` of variants at two bits, and the rows they are of; a bitmap turns away nearly all."""
        import numpy as np

        part = frame["low"].to_numpy(np.int64).view(np.uint64)
        k, even = frame["k"].to_numpy(), frame["even"].to_numpy(bool)
        ones = np.uint64(1) << np.arange(low, dtype=np.uint64)
        size = np.uint64(max(10, min(26, int(8 * max(1, len(unique))).bit_length())))
        factor, shift = np.uint64(0x9E3779B97F4A7C15), np.uint64(64) - size
        bitmap = np.zeros(1 << int(size), bool)
        bitmap[(unique * factor) >> shift] = True
        i, j = np.triu_indices(low, 1)
        for chosen, masks in (
            (even & (k == 0), ones[i] | ones[j]), (even & (k == 1), ones), (even & (k == 2), np.zeros(1, np.uint64)),
        ):
            rows = np.flatnonzero(chosen)
            step = max(1, (1 << 20) // max(1, len(masks)))
            for at in range(0, len(rows), step) if len(unique) else ():
                mine = rows[at:at + step]
                tried = part[mine][:, None] ^ masks
                r, c = np.nonzero(bitmap[(tried * factor) >> shift])
                wanted = tried[r, c]
                place = np.minimum(np.searchsorted(unique, wanted), len(unique) - 1)
                hit = unique[place] == wanted
                yield place[hit], mine[r[hit]]

    def stars(frame):
        import numpy as np
        import pandas as pd

        node = frame["node"].to_numpy(np.int64)
        keys, owner, starts = variants(frame)
        owner = node[owner]
        centre = np.repeat(owner[starts], np.diff(np.r_[starts, len(keys)]))
        met = centre != owner
        found = [np.unique(np.stack([centre[met], owner[met]], 1), axis=0)]
        roots = owner[starts]
        for place, row in visits(frame, keys[starts]):
            a, b = roots[place], node[row]
            found.append(np.unique(np.stack([a[a != b], b[a != b]], 1), axis=0))
        made = np.unique(np.concatenate(found), axis=0)
        give_back()
        return pd.DataFrame({"a": made[:, 0], "b": made[:, 1]})

    return stars


def near_groups(docs: DataFrame, shingle: int = 3, bits: int = 64, tables: int = 1) -> DataFrame:
    """``doc_id``, ``prints`` and ``component_id``, the smallest doc_id of the group.

    Two documents are linked if a fingerprint of both differs by three bits or
    fewer; groups are what links connect. Equal sketches are one node from the start, so
    exact copies, however many, cost one row. Rows without a doc_id make no group: they
    take that of an equal sketch, or null. Repeated rows stay; no rows give none.
    """
    sketched = stored(sketches(docs, shingle, bits, tables))
    nodes = stored(sketched.where("doc_id IS NOT NULL").groupBy("prints").agg(F.min("doc_id").alias("node")))
    roots = components(links(nodes, bits))
    named = nodes.join(roots, "node", "left").select("prints", F.coalesce("root", "node").alias("component_id"))
    return sketched.join(named, "prints", "left").select("doc_id", "prints", "component_id")


def op1_simhash(spark: SparkSession, sf: str) -> DataFrame:
    groups = near_groups(table(spark, sf, "documents"))
    return groups.select(
        "doc_id", F.lower(F.lpad(F.hex(F.col("prints")[0]), 16, "0")).alias("fingerprint"), "component_id"
    )


def near_dedup(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    """Pipeline stage: the document with the smallest doc_id of each group stays.

    Groups are those of ``near_groups`` as it stands: three-word shingles, 64 bits, and
    three bits at most between fingerprints. Rows without a doc_id stay; of rows that
    repeat one, one stays.
    """
    kept = near_groups(docs).where("doc_id = component_id").select("doc_id").distinct()
    known = documents(docs)
    once = (
        known.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(F.struct(*known.columns)).alias("row"))
        .join(kept, "doc_id", "left_semi").select("row.*")
    )
    return once.unionByName(known.where("doc_id IS NULL"))


QUERIES = {"op1_simhash": (op1_simhash, None)}
