"""Merkle manifest of a dataset: digests, inclusion proofs and their folding.

Every row is a leaf.  The leaves of a source, ascending by id, are reduced 16
at a time until one digest (the subroot) remains; the subroots, ascending by
source, are reduced likewise to the root.  A proof holds the siblings of a leaf
from its own run up to the root.

Leaves get their place in the source from a range sort and per-partition
counts, never from one window over a source.  Places are cut into superblocks
of 16^3 leaves (``levels`` = 3).  Going up, a superblock is reduced in its own task, and the
superblocks of a long source are the nodes of the next tier (each tier is 4096
times smaller).  Going down, the rows of a superblock and the outer nodes it
needs (the siblings of its ancestors, a few kilobytes) are cogrouped:
``applyInPandas`` reduces the superblock again, joins the proofs and folds
them.  A source with a third of all rows is as many superblocks as it needs.

Defined results: a null field counts as the text ``-``; null ids come first in
their source and are never tampered with; rows equal in all five fields are
leaves of their own, in any order; an empty table gives no rows.  Extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import crc_mod, lower_ascii, places

FAN = 16
LEVELS = 3               # levels reduced in one task: a superblock holds FAN**LEVELS nodes
HEX = 64                 # characters of a digest
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

#: An outer path: per level above, the place of the node in its run, the size of the run, and
#: the other nodes of all these runs as one text; then the digests at its end.
PATH = "spots array<int>, sizes array<int>, others string, subroot string, root string"


def framed(value: Column) -> Column:
    """A field as ``length:value`` (length in UTF-8 bytes), ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(fields: dict[str, Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[framed(fields[f]) for f in FIELDS]), 256))


def leaves(docs: DataFrame, every: int = 5) -> DataFrame:
    """(grp, doc_id, uid, digest, bent): the leaf of each row and, where ``every``
    divides the checksum of its id, the leaf with A-Z of the text lower-cased."""
    plain = {f: F.col(f) for f in FIELDS}
    bent = leaf_of({**plain, "text": lower_ascii(F.col("text"))})
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("grp"),  # null sorts before all others
        F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("uid"),
        leaf_of(plain).alias("digest"), F.when(crc_mod(F.col("doc_id"), every) == 0, bent).alias("bent"),
    )
    return materialise(rows, "leaves")


# ---- inside a superblock -------------------------------------------------------


def levels_above(n: int) -> int:
    """Levels until one of ``n`` nodes remains."""
    k = 0
    while n > 1:
        n, k = -(-n // FAN), k + 1
    return k


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def reduce(nodes: list[str], n: int, levels: int) -> list[list[str]]:
    """Levels from ``nodes`` up to the one digest of a superblock of a group of ``n`` nodes."""
    out = [nodes]
    for _ in range(min(levels, levels_above(n))):
        out.append([digest("".join(out[-1][i:i + FAN])) for i in range(0, len(out[-1]), FAN)])
    return out


class Path(NamedTuple):
    spots: list[int]
    sizes: list[int]
    others: str


def path_of(levels: list[list[str]], outer: Path) -> Iterator[Path]:
    """The way from each node of ``levels[0]`` through the superblock and on along ``outer``.

    The part above a node is made once for all nodes of its run.
    """
    above = [outer]
    for nodes in reversed(levels[:-1]):
        below = []
        for run, up in enumerate(above):
            members = nodes[run * FAN:(run + 1) * FAN]
            text = "".join(members)
            for spot in range(len(members)):
                rest = text[:spot * HEX] + text[(spot + 1) * HEX:]
                below.append(Path([spot, *up.spots], [len(members), *up.sizes], rest + up.others))
        above = below
    return iter(above)


def fold(leaf: str, path: Path) -> str:
    """The digest at the end of ``path`` when ``leaf`` stands at its start."""
    at = 0
    for spot, size in zip(path.spots, path.sizes):
        cut, end = at + spot * HEX, at + (size - 1) * HEX
        leaf = digest(path.others[at:cut] + leaf + path.others[cut:end])
        at = end
    return leaf


# ---- tiers ---------------------------------------------------------------------


def _blocks(nodes: DataFrame, levels: int, *columns) -> DataFrame:
    """``nodes`` with the number of their superblock."""
    return nodes.select("grp", F.floor(F.col("pos") / FAN**levels).alias("block"), "pos", "n", "digest", *columns)


def _reduced(nodes: DataFrame, levels: int) -> DataFrame:
    """One node per superblock: (grp, pos, n, digest), ``n`` superblocks in its group."""

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows, n = rows.sort_values("pos"), int(rows["n"].iloc[0])
        top = reduce([d.hex() for d in rows["digest"]], n, levels)[-1]
        return pd.DataFrame({"grp": [key[0]], "pos": [key[1]], "n": [-(-n // FAN**levels)], "digest": [bytes.fromhex(top[0])]})

    return _blocks(nodes, levels).groupBy("grp", "block").applyInPandas(run, "grp string, pos long, n long, digest binary")


def tiers(nodes: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """The tiers above ``nodes`` (grp, pos, n, digest) that hold several superblocks
    of a group, and the digest of every group: (grp, digest).  One round for every
    4096-fold of the longest group."""
    found, tops = [], None
    while True:
        blocks = materialise(_reduced(nodes, levels), "superblocks")
        done = blocks.where("n = 1").select("grp", "digest")
        tops = done if tops is None else tops.unionByName(done)
        nodes = blocks.where("n > 1")
        if not nodes.limit(1).count():
            return found, tops
        found.append(nodes)


def _descended(nodes: DataFrame, outer: DataFrame, levels: int) -> DataFrame:
    """The paths of ``nodes`` from the outer paths of their superblocks (grp, block, PATH)."""

    def run(key, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows, up = rows.sort_values("pos"), above.iloc[0]
        nodes = reduce([d.hex() for d in rows["digest"]], int(rows["n"].iloc[0]), levels)
        paths = path_of(nodes, Path(list(up["spots"]), list(up["sizes"]), up["others"]))
        return pd.DataFrame({"grp": key[0], "block": rows["pos"].to_numpy(),
                             **dict(zip(("spots", "sizes", "others"), map(list, zip(*paths)))),
                             "subroot": up["subroot"], "root": up["root"]})

    return _blocks(nodes, levels).groupBy("grp", "block").cogroup(outer.groupBy("grp", "block")).applyInPandas(run, f"grp string, block long, {PATH}")


def descend(above: list[DataFrame], outer: DataFrame, levels: int) -> DataFrame:
    """From the outer path of each group down to those of the lowest superblocks."""
    for nodes in reversed(above):
        here = nodes.select("grp").distinct()  # the other groups end at a lower tier
        below = _descended(nodes, outer.join(here, "grp", "left_semi"), levels)
        outer = materialise(outer.join(here, "grp", "left_anti").unionByName(below), "paths")
    return outer


# an id travels as text: pandas has no long with nulls
PROOF = "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def manifest(docs: DataFrame, every: int = 5, levels: int = LEVELS) -> DataFrame:
    """One row per row of ``docs``: its leaf, the subroot of its source, the root,
    the digest of its proof, and the root folded from the (tampered) leaf."""
    rows = places(leaves(docs, every), ["grp"], ["doc_id", "digest", "uid"], "leaves_in_order")
    above, subroots = tiers(rows.select("grp", "pos", "n", "digest"), levels)

    # the subroots are the nodes of one group; their paths end at the root
    ordered = places(subroots.select(F.lit("").alias("all"), "grp", "digest"), ["all"], ["grp"], "subroots")
    tops, root = tiers(ordered.select(F.col("all").alias("grp"), "pos", "n", "digest"), levels)
    empty = F.array().cast("array<int>")
    start = root.select(
        "grp", F.lit(0).cast("long").alias("block"), empty.alias("spots"), empty.alias("sizes"), F.lit("").alias("others"),
        F.lit(None).cast("string").alias("subroot"), F.lower(F.hex("digest")).alias("root"))
    lowest = descend(tops, start, levels)
    to_root = _descended(ordered.select(F.col("all").alias("grp"), "pos", "n", "digest"), lowest, levels)
    outer = ordered.join(to_root.select(F.col("block").alias("pos"), "spots", "sizes", "others", "root"), "pos").select(
        "grp", F.lit(0).cast("long").alias("block"), "spots", "sizes", "others", F.lower(F.hex("digest")).alias("subroot"), "root")
    outer = descend(above, materialise(outer, "paths"), levels)

    def run(key, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows, up = rows.sort_values("pos"), above.iloc[0]
        own = [d.hex() for d in rows["digest"]]
        nodes = reduce(own, int(rows["n"].iloc[0]), levels)
        proofs, folded = [], []
        paths = path_of(nodes, Path(list(up["spots"]), list(up["sizes"]), up["others"]))
        for leaf, bent, path in zip(own, rows["bent"], paths):
            proofs.append(digest(path.others))
            folded.append(fold(leaf if bent is None else bent.hex(), path))
        return pd.DataFrame({
            "id": rows["id"], "leaf": own, "subroot": up["subroot"], "root": up["root"],
            "proof_sha256": proofs, "folded_root": folded, "verified": [f == up["root"] for f in folded]})

    cut = _blocks(rows, levels, F.col("doc_id").cast("string").alias("id"), "bent")
    proven = cut.groupBy("grp", "block").cogroup(outer.groupBy("grp", "block")).applyInPandas(run, PROOF)
    return proven.select(F.col("id").cast("long").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: crc32 of a list of bytes, by the table of the polynomial 0xEDB88320.
CRC_SQL = """
crc_table AS (SELECT list_transform(range(256), lambda b: list_reduce(range(8),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS crc_of)
"""


def crc_of_bytes(values: str) -> str:
    """SQL for the crc32 of a list of byte values; ``crc_of`` is in scope."""
    return f"xor(list_reduce({values}, lambda c, b: xor(crc_of[(xor(c, b) & 255) + 1], c >> 8), 4294967295), 4294967295)"


def _framed_sql(text: str) -> str:
    def one(x: str) -> str:
        return f"coalesce(strlen({x}::VARCHAR)::VARCHAR || ':' || {x}::VARCHAR, '-')"

    return "sha256(" + " || ".join(one(text if f == "text" else f) for f in FIELDS) + ")"


def _rest(p: str) -> str:
    return f"array_to_string(hs[1:{p}], '') || array_to_string(hs[{p} + 2:], '')"


_SQL_RUN = "array_to_string(hs[1:pos % 16], '') || f || array_to_string(hs[pos % 16 + 2:], '')"

SQL = f"""
WITH RECURSIVE {CRC_SQL.strip()},
doc AS (
  SELECT doc_id, source, {_framed_sql("text")} AS leaf,
         CASE WHEN {crc_of_bytes("list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)")} % 5 = 0
              THEN {_framed_sql(f"translate(text, '{_UPPER}', '{_LOWER}')")} END AS bent
  FROM documents, crc_table),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY source) AS n, row_number() OVER () AS uid FROM doc),
up(source, lvl, pos, h, n) AS (
  SELECT source, 0, pos, leaf, n FROM placed
  UNION ALL
  SELECT source, lvl + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 15) // 16
  FROM up WHERE n > 1 GROUP BY source, lvl, pos // 16),
sub AS (SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
over(lvl, pos, h, n) AS (
  SELECT 0, pos, h, n FROM sub
  UNION ALL
  SELECT lvl + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 15) // 16 FROM over WHERE n > 1 GROUP BY lvl, pos // 16),
runs AS (SELECT source, lvl, pos // 16 AS run, list(h ORDER BY pos) AS hs FROM up WHERE n > 1 GROUP BY ALL),
over_runs AS (SELECT lvl, pos // 16 AS run, list(h ORDER BY pos) AS hs FROM over WHERE n > 1 GROUP BY ALL),
way(uid, source, lvl, pos, proof, f) AS (
  SELECT uid, source, 0, pos, '', coalesce(bent, leaf) FROM placed
  UNION ALL
  SELECT uid, way.source, way.lvl + 1, pos // 16, proof || {_rest("pos % 16")}, sha256({_SQL_RUN})
  FROM way JOIN runs ON way.source IS NOT DISTINCT FROM runs.source AND way.lvl = runs.lvl AND pos // 16 = run),
at_sub AS (SELECT uid, arg_max(proof, lvl) AS proof, arg_max(f, lvl) AS f FROM way GROUP BY uid),
on_(uid, lvl, pos, proof, f) AS (
  SELECT uid, 0, sub.pos, proof, f FROM at_sub JOIN placed USING (uid) JOIN sub ON sub.source IS NOT DISTINCT FROM placed.source
  UNION ALL
  SELECT uid, on_.lvl + 1, pos // 16, proof || {_rest("pos % 16")}, sha256({_SQL_RUN})
  FROM on_ JOIN over_runs ON on_.lvl = over_runs.lvl AND pos // 16 = run),
ended AS (SELECT uid, arg_max(proof, lvl) AS proof, arg_max(f, lvl) AS f FROM on_ GROUP BY uid)
SELECT doc_id, leaf, sub.h AS subroot, r.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = r.h AS verified
FROM placed JOIN ended USING (uid) JOIN sub ON sub.source IS NOT DISTINCT FROM placed.source, (SELECT h FROM over WHERE n = 1) r
"""
