"""SimHash near-duplicates: fingerprints, links by meet-in-the-middle ball hashing, and linked groups.

Two fingerprints at distance r or less (r even) share at least one variant at distance r/2 or less from each. Every
distinct fingerprint therefore emits its ball of variants, the shuffle brings equal variants together, and whatever
meets there is at most r apart. A variant's meeting holds at most one ball of fingerprints however large a group of
copies is, since equal fingerprints are made one before; members are linked in a chain, not in all pairs.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import map_texts
from candlewick.session import stage


def simhash(text: bytes, size: int) -> int:
    """Signed 64-bit fingerprint: the bits that are set in over half the hashes of all word shingles."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= size:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(42)), np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(df: DataFrame, text: str = "text", keep: list[str] | None = None, shingle: int = 3) -> DataFrame:
    """`keep` and fp (bigint) of every whole text; without words it is 0. Narrow: no shuffle."""

    def start():
        return lambda texts: [[simhash(t, shingle) for t in texts]]

    return map_texts(df, [text], ["doc_id"] if keep is None else keep, [("fp", "bigint")], start)


def ball(radius: int) -> list[int]:
    """All 64-bit masks with `radius` or fewer bits, as signed numbers."""
    masks = [sum(1 << b for b in bits) for k in range(radius + 1) for bits in combinations(range(64), k)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def links(prints: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints `fp` at `distance` or fewer bits, a < b."""
    if distance < 0 or distance % 2:
        raise ValueError("the distance must be even: both sides go half the way")
    masks = ", ".join(f"{m}L" if m > -(1 << 63) else "CAST('-9223372036854775808' AS BIGINT)" for m in ball(distance // 2))
    variants = prints.select("fp", F.explode(F.expr(f"transform(array({masks}), m -> fp ^ m)")).alias("variant"))
    # lag over the sorted meeting: its members are pairwise within the distance, so a chain links them all
    shuffled = variants.selectExpr("variant", "fp", "lag(fp) OVER (PARTITION BY variant ORDER BY fp) AS before")
    pairs = shuffled.where("before IS NOT NULL").selectExpr("before AS a", "fp AS b")
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and label (the smallest node reachable) for all nodes of the links (a, b).

    Each round takes the least label among the neighbours and then jumps to the label's own label, until nothing
    changes. Every round is written to the shared folder, so a lost executor costs no earlier round. Links are
    joined on nodes with few neighbours; labels, which a large group shares, are joined from stored tables, where
    Spark splits a hot key.
    """
    both = stage(edges.select(F.col("a").alias("src"), F.col("b").alias("dst")).unionAll(
        edges.select(F.col("b").alias("src"), F.col("a").alias("dst"))), "links")
    labels = stage(both.groupBy(F.col("src").alias("node")).agg(F.least(F.min("dst"), F.first("src")).alias("label")), "labels")
    while True:
        near = both.join(labels, both.dst == labels.node).groupBy("src").agg(F.min("label").alias("near"))
        hooked = stage(labels.join(near, labels.node == near.src, "left").select(
            "node", F.least("label", "near").alias("label"), F.col("label").alias("old")), "hooked")
        roots = hooked.select(F.col("node").alias("root"), F.col("label").alias("top"))
        after = stage(hooked.join(roots, hooked.label == roots.root, "left").select(
            "node", F.coalesce("top", "label").alias("label"), "old"), "labels")
        changed = after.where("label <> old").limit(1).count()
        labels = after.select("node", "label")
        if not changed:
            return labels


def members(docs: DataFrame, order, distance: int) -> DataFrame:
    """fp, least and label of every distinct fingerprint of `docs`: the least `order` of its rows, and its component."""
    prints = stage(docs.groupBy("fp").agg(F.min(order).alias("least")), "prints")
    labels = components(stage(links(prints, distance), "pairs"))
    return stage(prints.join(labels, prints.fp == labels.node, "left").select(
        "fp", "least", F.coalesce("label", "fp").alias("label")), "members")


def near_duplicates(df: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 3, distance: int = 2) -> DataFrame:
    """One row per document: the key, fp and component_id, the least key among all documents reachable by links.

    Documents whose fingerprints differ in `distance` or fewer bits are linked. Null and empty texts have the
    fingerprint 0 and are linked like any other; a null key passes through but names no component (a component
    without any key has a null id); repeated rows give repeated rows; an empty table gives an empty table; other
    columns of the input are not read.
    """
    docs = stage(fingerprints(df, text, [key], shingle), "fingerprints")
    prints = members(docs, F.col(key), distance)
    groups = stage(prints.groupBy("label").agg(F.min("least").alias("component_id")), "groups")
    named = stage(prints.join(groups, "label").select(F.col("fp").alias("print"), "component_id"), "named")
    return docs.join(named, docs.fp == named.print).select(key, "fp", "component_id")


def keep_one(df: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 3, distance: int = 2) -> DataFrame:
    """One row of each component; the rest of each group goes. Columns stay as they are.

    The row with the least key stays, rows without a key come last, then the hash of the text decides, and among equal
    texts any one stays. Rows are told apart by a written row id, not by their key: rows without a key, or with the
    same one, go only as copies of each other or of another row.
    """
    places = [f"c{i}" for i in range(len(df.columns))]
    rows = df.toDF(*places)
    text, key = places[df.columns.index(text)], places[df.columns.index(key)]
    rows = stage(rows.select("*", F.xxhash64(text).alias("hash"), F.monotonically_increasing_id().alias("row")), "rows")
    docs = stage(fingerprints(rows, text, [key, "hash", "row"], shingle), "fingerprints")
    prints = members(docs, F.struct(F.col(key).isNull().alias("none"), key, "hash", "row"), distance)
    kept = stage(prints.groupBy("label").agg(F.min("least").alias("least")).select("least.row"), "kept")
    return rows.join(kept.hint("merge"), "row", "left_semi").select(*places).toDF(*df.columns)


def op6_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprints and components of all documents: three-word shingles, two bits."""
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
