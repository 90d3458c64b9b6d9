"""Best-fit packing of tokenised documents into fixed-length sequences by a grouping genetic algorithm.

Each document's ids get the end id; longer ones are cut into full pieces behind a shorter first one. Full pieces are
sequences by themselves. The first pieces are dealt by hash into blocks of bounded size, each block to several
islands. An island's chromosome is a grouping (a list of bins): crossover injects well-filled bins of one parent
whole into the other, removes the bins that hold a second copy of an item, and best-fits the displaced items,
longest first. Between epochs each island's elite moves on to its neighbour in a shuffle. Bins that stay loose after
the last epoch are opened and their items packed again, in blocks of the same bound that gather the loose ends of many.

Null text is empty text: one piece, the end id alone. Rows are packed one by one, so repeated rows and ties get a place
each; an empty table gives no rows. Only the id and text columns are read.
"""

from __future__ import annotations

import json
import os
import random
import re
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableforge.llm import bpe, common

BLOCK_ITEMS, ISLANDS, EPOCHS, GENERATIONS, POPULATION = 4096, 2, 2, 6, 4
#: Bins with at least this share of the capacity are final after the first level.
TIGHT = 0.995


#: The bytes that a byte-level vocabulary writes as themselves; the others follow from U+0100 on, in order.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: A longer run of white space overflows the rank coder's stack; texts that hold one go through the tokenizers file.
LONG_BLANK = 10_000
_LONG_BLANK = re.compile(rf"\s{{{LONG_BLANK}}}")


def token_bytes(token: str) -> bytes:
    """The bytes of a byte-level vocabulary's token."""
    table = _byte_of()
    return bytes(table[c] for c in token)


@lru_cache(maxsize=1)
def _byte_of() -> dict[str, int]:
    others = [b for b in range(256) if b not in set(_PRINTED)]
    return {chr(b): b for b in _PRINTED} | {chr(256 + k): b for k, b in enumerate(others)}


class Tokenizer:
    """Texts to ids by a tokenizers file. A plain byte-level BPE whose merges stand in the order of their ids is a rank
    table too, which tiktoken encodes several times faster to the same ids; texts that hold a special token's string or a
    very long run of white space, and files of any other kind, go through tokenizers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer as Base

        self.base = Base.from_file(path)
        self.special = [t.content for t in self.base.get_added_tokens_decoder().values()]
        self.fast = self.ranked(path)

    def ranked(self, path: str):
        """The same vocabulary for tiktoken, or None where the file asks for more than ranks say."""
        with open(path, "rb") as f:
            file = json.load(f)
        model, cutter = file["model"], file.get("pre_tokenizer") or {}
        plain = model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        if not plain or file.get("normalizer") or cutter.get("type") != "ByteLevel" or cutter.get("add_prefix_space") or not cutter.get("use_regex", True):
            return None
        vocab, added = model["vocab"], {t["content"] for t in file.get("added_tokens", [])}
        made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        single = [i for t, i in vocab.items() if len(t) == 1]
        if made != sorted(made) or (made and max(single) > made[0]):
            return None
        ranks = {token_bytes(t): i for t, i in vocab.items() if t not in added}
        return tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        slow = [k for k, t in enumerate(texts) if self.fast is None or any(s in t for s in self.special) or (len(t) >= LONG_BLANK and _LONG_BLANK.search(t))]
        out = [b""] * len(texts)
        for k, e in zip(slow, self.base.encode_batch_fast([texts[k] for k in slow], add_special_tokens=False), strict=True):
            out[k] = array("I", e.ids).tobytes()
        for k in set(range(len(texts))).difference(slow):
            out[k] = b"".join(array("I", self.fast.encode_ordinary(part)).tobytes() for part in bpe.safe_parts(texts[k]))
        return out


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer(path)


def pieces(df: DataFrame, path: str, end_id: int, capacity: int, id_col: str, text_col: str) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32."""
    end = array("I", [end_id]).tobytes()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder, texts = tokenizer(path), batch.column(1).fill_null("")
        rows = []
        for lo in range(0, len(texts), 200):
            for i, ids in enumerate(coder.encode(texts.slice(lo, 200).to_pylist()), lo):
                ids += end
                n = len(ids) // 4
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)] if n > capacity else [0, n]
                rows += [(i, k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
        i, k, a, n, crc = (np.array(x, np.int64) for x in zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(i)), pa.array(k.astype(np.int32)), pa.array(a), pa.array(n), pa.array(crc)], [id_col, "piece", "start", "length", "ids_crc32"])

    kind = df.schema[id_col].dataType.simpleString()
    return common.map_arrow(df.select(id_col, text_col), run, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long")


def best_fit(items: list[int], sizes: list[int], bins: list[list[int]], capacity: int) -> list[list[int]]:
    """Put each item, in the given order, into the bin that it leaves the least room in. A bin is a list: its fill, then
    its items. Bit r of ``rooms`` says that some bin has room r, so the best bin is the lowest bit from the size on."""
    by_room: dict[int, list[int]] = {}
    rooms = 0
    for k, members in enumerate(bins):
        if room := capacity - members[0]:
            by_room.setdefault(room, []).append(k)
            rooms |= 1 << room
    for i in items:
        size = sizes[i]
        if fits := rooms >> size:
            room = size + (fits & -fits).bit_length() - 1
            k = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            bins[k].append(i)
            bins[k][0] += size
        else:
            room, k = capacity, len(bins)
            bins.append([size, i])
        if room := room - size:
            by_room.setdefault(room, []).append(k)
            rooms |= 1 << room
    return bins


def crossover(a: list[list[int]], b: list[list[int]], sizes: list[int], capacity: int, rng: random.Random) -> list[list[int]]:
    """Well-filled bins of ``b`` go whole into ``a``."""
    full = [m for m in b if m[0] >= TIGHT * capacity]
    taken = rng.sample(full, len(full) // 2)
    inside = {i for m in taken for i in m[1:]}
    kept, displaced = [list(m) for m in taken], []
    for members in a:
        if inside.isdisjoint(items := members[1:]):
            kept.append(list(members))
        else:
            displaced += [i for i in items if i not in inside]
    return best_fit(sorted(displaced, key=lambda i: -sizes[i]), sizes, kept, capacity)


def mutate(a: list[list[int]], sizes: list[int], capacity: int, rng: random.Random) -> list[list[int]]:
    """Open the loosest bins and as many others, and best-fit their items."""
    order = sorted(a, key=lambda m: m[0])
    n = max(1, len(a) // 20)
    chosen = order[:n] + rng.sample(order[n:], min(n, len(order) - n))
    drop = set(map(id, chosen))
    items = [i for m in chosen for i in m[1:]]
    return best_fit(sorted(items, key=lambda i: -sizes[i] * rng.uniform(0.9, 1.1)), sizes, [list(m) for m in a if id(m) not in drop], capacity)


def fitness(bins: list[list[int]]) -> tuple[int, int]:
    """Fewer bins first, then the more uneven fills: room in one bin is of more use than scattered."""
    return len(bins), -sum(m[0] * m[0] for m in bins)


def evolve(sizes: list[int], capacity: int, seed: int, elites: list[list[list[int]]]) -> list[list[int]]:
    """The best grouping that an island finds, starting from the elites that reached it."""
    rng = random.Random(seed)
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    least = -(-sum(sizes) // capacity)
    population = elites or [best_fit(order, sizes, [], capacity)]
    if min(map(len, population)) > least:
        while len(population) < POPULATION:
            population.append(best_fit(sorted(order, key=lambda i: -sizes[i] * rng.uniform(0.8, 1.25)), sizes, [], capacity))
    for _ in range(GENERATIONS):
        population.sort(key=fitness)
        if len(population[0]) <= least:
            break
        a, b = population[0], rng.choice(population[1:])
        children = [crossover(a, b, sizes, capacity, rng), crossover(b, a, sizes, capacity, rng), mutate(a, sizes, capacity, rng)]
        population = sorted(population + children, key=fitness)[:POPULATION]
    return min(population, key=fitness)


def island_epoch(capacity: int):
    """One epoch of one island: its rows hold one grouping for each island that sent an elite (bin null: none yet)."""

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        block, island = (int(k) for k in key)
        items = rows.drop_duplicates("uid").sort_values("uid")
        sizes, place = items["length"].tolist(), {u: i for i, u in enumerate(items["uid"].tolist())}
        elites = []
        for _, sent in rows[rows["bin"] >= 0].sort_values("uid").groupby("sent_by"):
            elites.append([[sum(sizes[place[u]] for u in m), *(place[u] for u in m)] for m in sent.groupby("bin", sort=True)["uid"].agg(list)])
        best = evolve(sizes, capacity, block * 1009 + island, elites)
        bins = np.empty(len(sizes), np.int64)
        for k, members in enumerate(best):
            bins[members[1:]] = k
        count, unevenness = fitness(best)
        return pd.DataFrame({"block": block, "sent_by": island, "uid": items["uid"], "length": items["length"], "bin": bins, "n_bins": count, "unevenness": unevenness})

    return run


def pack(items: DataFrame, capacity: int, n_blocks: int) -> DataFrame:
    """(uid, length, sequence_id, offset, fill) of items (uid, length) by blocks, islands and epochs."""
    state = "block long, sent_by int, uid long, length long, bin long, n_bins long, unevenness long"
    rows = items.select(F.pmod(F.xxhash64("uid"), F.lit(n_blocks)).alias("block"), F.lit(-1).alias("sent_by"), "uid", "length", F.lit(-1).cast("long").alias("bin"))
    for epoch in range(EPOCHS):
        reach = F.array(*map(F.lit, range(ISLANDS))) if epoch == 0 else F.array("sent_by", ((F.col("sent_by") + 1) % ISLANDS))
        rows = rows.withColumn("island", F.explode(reach)).groupBy("block", "island").applyInPandas(island_epoch(capacity), state)

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        best = rows.sort_values(["n_bins", "unevenness", "sent_by"]).iloc[0]["sent_by"]
        rows = rows[rows["sent_by"] == best].sort_values(["bin", "uid"])
        by = rows.groupby("bin")
        return pd.DataFrame({"uid": rows["uid"], "length": rows["length"], "sequence_id": by["uid"].transform("min"), "offset": by["length"].cumsum() - rows["length"], "fill": by["length"].transform("sum")})

    return rows.groupBy("block").applyInPandas(place, "uid long, length long, sequence_id long, offset long, fill long")


def packed(df: DataFrame, path: str | None = None, end_id: int = 2, capacity: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document."""
    cut = pieces(df, path or public_tokenizers.path("byte_bpe_50k.json"), end_id, capacity, id_col, text_col)
    cut = common.materialise(cut.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    loose = cut.where(F.col("length") < capacity).select("uid", "length")
    n_blocks = max(1, -(-loose.count() // BLOCK_ITEMS))
    first = pack(loose, capacity, n_blocks)
    if n_blocks > 1:
        first = common.materialise(first, "packed")
        tight = F.col("fill") >= TIGHT * capacity
        open_ = first.where(~tight).select("uid", "length")
        again = pack(open_, capacity, max(1, -(-open_.count() // BLOCK_ITEMS)))
        first = first.where(tight).unionByName(again)
    alone = cut.where(F.col("length") == capacity).withColumns({"sequence_id": -1 - F.col("uid"), "offset": F.lit(0).cast("long")})
    placed = cut.where(F.col("length") < capacity).join(first.select("uid", "sequence_id", "offset"), "uid")
    return alone.unionByName(placed).drop("uid")


def op2_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return packed(common.documents(spark, sf_dir))
