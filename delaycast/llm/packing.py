"""Best-fit packing of tokenized documents into sequences of bounded length.

Hierarchical residual packing: every partition best-fits its own pieces, nearly
full sequences are final, and the underfull ones travel on as items of the next
round, over fewer and fewer partitions. No task ever holds more than
`task_items` items, so a round over many underfull sequences stays spread out.
"""

from __future__ import annotations

import functools
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kit import lean, stored

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long, used long, done boolean"
CACHED_WORDS = 200_000


#: Characters beyond Latin-1, and the separators that Python alone takes for white space.
_odd = re.compile(r"[^\x00-\x1b\x20-\xff]").search


class WordTokenizer:
    """Ids of whole texts by a word-level BPE file of the `tokenizers` library.

    Its normalizer lower-cases and its splitter cuts at white space and character
    classes, so a text of Latin-1 characters is the concatenation of its runs
    between white space, whose ids are kept. Any other text, or one that may name a special token, goes to the
    tokenizer as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.whole = Tokenizer.from_file(path)
        kind = {k: "".join(re.escape(chr(i)) for i in range(256) if unicodedata.category(chr(i))[0] == k) for k in "LN"}
        blank = r"\t-\r \x85\xa0"
        self.words = re.compile(rf"[{kind['L']}]+|'(?:s|t|re|ve|m|ll|d)|[{kind['N']}]|[^{blank}{kind['L']}{kind['N']}]+").findall
        self.merge = self.whole.model.tokenize
        by_byte = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.symbols = {i: "".join(x for x, _ in by_byte(chr(i))) for i in range(256)}  # of each character's bytes
        self.known: dict[str, bytes] = {}

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if "<|" in text or _odd(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        runs = text.lower().split()
        try:
            return b"".join(map(self.known.__getitem__, runs))
        except KeyError:
            pass
        known = self.known
        room = len(known) < CACHED_WORDS
        out = []
        for run in runs:
            ids = known.get(run)
            if ids is None:
                ids = b"".join([known.get(w) or self.word(w) for w in self.words(run)])
                if room:
                    known[run] = ids
            out.append(ids)
        return b"".join(out)

    def word(self, word: str) -> bytes:
        ids = [t.id for t in self.merge(word.translate(self.symbols))]
        return struct.pack(f"<{len(ids)}I", *ids)


@functools.lru_cache(2)
def word_tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def pieces(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """One row per piece: whole documents (ids, then `end_id`), cut only beyond `capacity`.

    A null or empty text is the end id alone; a null doc_id stays null; repeated
    rows are separate documents.
    """
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = word_tokenizer(path)
        for frame in frames:
            rows = []
            for doc, text in zip(frame["doc_id"].astype("Int64"), frame["text"]):
                ids = tokenizer.ids(text) + end
                for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at: at + 4 * capacity]
                    rows.append((doc, n, at // 4, len(part) // 4, zlib.crc32(part)))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"]).astype({"doc_id": "Int64"})

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInPandas(lean(cut), PIECES)


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each item: longest first, each into the fullest bin that has room."""
    bins_of = np.empty(len(lengths), dtype=np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = bins = 0  # bit r of rooms: some bin has room r
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        if fits := rooms >> size:
            room = size + (fits & -fits).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, at = capacity, bins
            bins += 1
        bins_of[i] = at
        by_room[room - size].append(at)
        rooms |= 1 << (room - size)
    return bins_of


def pack_items(frame: pd.DataFrame, capacity: int, slack: int, first_id: int) -> pd.DataFrame:
    """Best-fit the items (rows of one sequence_id are an item) of a frame."""
    frame = frame.sort_values(["sequence_id", "offset"], kind="stable")
    ids, first, item = np.unique(frame["sequence_id"].to_numpy(), return_index=True, return_inverse=True)
    used = frame["used"].to_numpy()[first]
    bins = best_fit(used, capacity)
    order = np.lexsort((np.arange(len(ids)), bins))
    filled = np.bincount(bins, weights=used).astype(np.int64)
    before = np.cumsum(used[order]) - used[order]
    starts = np.concatenate(([0], np.cumsum(filled)[:-1]))
    place = np.empty(len(ids), dtype=np.int64)
    place[order] = before - starts[bins[order]]
    total = filled[bins[item]]
    return frame.assign(sequence_id=first_id + bins[item], offset=frame["offset"].to_numpy() + place[item],
                        used=total, done=total >= capacity - slack)


def pack(parts: DataFrame, capacity: int = 4096, slack: int = 8, task_items: int = 200_000, fan_in: int = 8) -> DataFrame:
    """Pack pieces (columns of PIECES) into sequences of at most `capacity`.

    Returns the pieces with sequence_id and offset (gapless from 0). `slack`:
    room at which a sequence counts as full. Lengths must be 1 to `capacity`;
    an empty table gives an empty result. Rounds end when one task has seen all
    that is left, or when a round no longer saves a hundredth of the sequences.
    """
    spark = parts.sparkSession

    def run(frames: Iterator[pd.DataFrame], turn: int) -> Iterator[pd.DataFrame]:
        context = TaskContext.get()
        next_id = (turn << 56) + ((context.partitionId() if context else 0) << 32)
        held, n = [], 0

        def flush():
            nonlocal next_id, held, n
            out = pack_items(pd.concat(held), capacity, slack, next_id)
            next_id, held, n = int(out["sequence_id"].max()) + 1, [], 0
            return out

        for frame in frames:
            if turn == 0:
                frame = frame.assign(sequence_id=np.arange(n, n + len(frame)), offset=0, used=frame["length"], done=False)
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            if len(frame):
                held.append(frame)
                n += len(frame)
            if turn == 0 and n >= task_items:
                yield flush()
        if held:
            yield flush()

    def one_round(df: DataFrame, turn: int) -> DataFrame:
        return stored(df.mapInPandas(lean(lambda frames: run(frames, turn)), PACKED), f"packed{turn}")

    rounds = [one_round(parts, 0)]
    tasks = max(1, len(rounds[0].inputFiles()))
    left = rounds[0].filter("not done").select("sequence_id").distinct().count()
    while left > 1:
        tasks = max(1, -(-left // task_items), tasks // fan_in)
        rounds.append(one_round(rounds[-1].filter("not done").repartition(tasks, "sequence_id"), len(rounds)))
        was, left = left, rounds[-1].filter("not done").select("sequence_id").distinct().count()
        full = rounds[-1].filter("done").select("sequence_id").distinct().count()
        if tasks == 1 or (left + full > 0.99 * was and tasks == -(-was // task_items)):
            break
    out = functools.reduce(DataFrame.unionByName, [r.filter("done") for r in rounds] + [rounds[-1].filter("not done")])
    return out.drop("used", "done")


def pack_documents(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    # the pieces, some 40 bytes each, are a table of their own: in one stage with the packing, each core would keep two Python workers
    return pack(stored(pieces(docs, path, capacity, end_id), "pieces"), capacity)
