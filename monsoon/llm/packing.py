"""Token packing by minimum bin slack.

A document becomes blocks of the window's length and one remainder. Every task takes its
remainders in blocks of bounded size and fills windows one after the other: the longest
remainder left is set, and a subset-sum over bitsets picks, from the lengths that remain,
the multiset that comes closest to the window; walking back through the bitsets gives how
often each length is used, and the pattern is repeated while the counts last. Windows that
stay short are joined and cut anew at the window's length, so that only the last one of a
task is short, and that is cut at powers of two, which need no padding.

Nothing is shuffled: tokens stay in the task that made them, and sequence numbers are made
of the partition and a counter.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 1024
BLOCK_TOKENS = 2_000_000
TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
END = 0

# Texts of these characters only are tokenized by the faster of two libraries that hold
# the same vocabulary; tests compare both over every such character.
PLAIN = r"[\n\x20-\x7e¡-¬®-ſ]*"

PIECE = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def tokenizer(name: str = TOKENIZER, ranks: str = RANKS):
    """A function from text to an array of ids, as ``tokenizers`` gives for ``name``."""
    import base64
    import re

    import numpy as np
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(public_tokenizers.path(name))
    with open(public_tokenizers.path(ranks), "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
    )
    plain = re.compile(PLAIN).fullmatch

    def ids(text: str):
        if "<|" not in text and plain(text):
            return np.asarray(fast.encode_ordinary(text), dtype="<u4")
        return np.asarray(exact.encode(text, add_special_tokens=False).ids, dtype="<u4")

    return ids


def fill(counts: dict[int, int], lengths: list[int], window: int) -> dict[int, int]:
    """How often to use each length so that one window comes closest to full.

    ``lengths`` are the keys of ``counts`` from long to short; the longest is always used.
    """
    seed = lengths[0]
    room = window - seed
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in lengths:
        if length > room:
            continue
        most = min(counts[length] - (length == seed), room // length)
        if most <= 0:
            continue
        steps.append((length, reach))
        step = 1
        while most > 0:
            take = min(step, most)
            reach |= (reach << (take * length)) & mask
            most -= take
            step *= 2
        if reach >> room & 1:
            break
    used = defaultdict(int, {seed: 1})
    at = reach.bit_length() - 1
    for length, before in reversed(steps):
        while not before >> at & 1:
            at -= length
            used[length] += 1
    return dict(used)


def patterns(counts: dict[int, int], window: int) -> Iterator[tuple[dict[int, int], int]]:
    """Patterns of lengths and how many windows take each, until no length is left."""
    counts = dict(counts)
    lengths = sorted(counts, reverse=True)
    while lengths:
        used = fill(counts, lengths, window)
        times = min(counts[length] // n for length, n in used.items())
        yield used, times
        for length, n in used.items():
            counts[length] -= n * times
            if not counts[length]:
                lengths.remove(length)


def joined(pieces: list, window: int) -> tuple[list[list], list]:
    """Pieces laid end to end and cut at the window: the full windows, and what is left."""
    full, now, size = [], [], 0
    for doc, start, ids, total in pieces:
        while len(ids):
            part = ids[: window - size]
            now.append((doc, start, part, total))
            size += len(part)
            start += len(part)
            ids = ids[len(part) :]
            if size == window:
                full.append(now)
                now, size = [], 0
    return full, now


def powers(pieces: list) -> list[list]:
    """Pieces cut into sequences whose lengths are powers of two, the longest first."""
    size = sum(len(p[2]) for p in pieces)
    out: list[list] = []
    while size:
        power = 1 << (size.bit_length() - 1)
        full, pieces = joined(pieces, power)
        out.append(full[0])
        pieces = [p for s in full[1:] for p in s] + pieces
        size -= power
    return out


def sequences(pieces: list, window: int) -> tuple[list[list], list]:
    """Full sequences made of the pieces, and the pieces that fill less than one."""
    by_length = defaultdict(list)
    for piece in pieces:
        by_length[len(piece[2])].append(piece)
    full, short = [], []
    for used, times in patterns({k: len(v) for k, v in by_length.items()}, window):
        exact = sum(k * n for k, n in used.items()) == window
        for _ in range(times):
            taken = [by_length[k].pop() for k, n in used.items() for _ in range(n)]
            if exact:
                full.append(taken)
            else:
                short.extend(taken)
    more, rest = joined(short, window)
    return full + more, rest


def _packer(window: int, block: int, end: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        encode = tokenizer()
        number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        last = np.array([end], dtype="<u4")
        rest: list = []

        def rows(found):
            nonlocal number
            out: list = []
            for sequence in found:
                offset = 0
                for doc, start, ids, total in sequence:
                    out.append((doc, start, len(ids), ids.tobytes(), total, number, offset))
                    offset += len(ids)
                number += 1
            return out

        def table(out, doc_type):
            kinds = (doc_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
            columns = list(zip(*out, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)], names=names
            )

        doc_type, held, out = None, 0, []
        for batch in batches:
            doc_type = batch.schema.field(0).type
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.concatenate([encode(text.as_py() or ""), last])
                total = len(ids)
                whole = total - total % window
                for start in range(0, whole, window):
                    out += rows([[(doc, start, ids[start : start + window], total)]])
                if whole < total:
                    rest.append((doc, whole, ids[whole:].copy(), total))
                held += total - whole
                if held >= block:
                    full, rest = sequences(rest, window)
                    out += rows(full)
                    held = sum(len(p[2]) for p in rest)
                if len(out) >= 4096:
                    yield table(out, doc_type)
                    out = []
        full, rest = sequences(rest, window)
        out += rows(full) + rows(powers(rest))
        for at in range(0, len(out), 4096):
            yield table(out[at : at + 4096], doc_type)

    return run


def pack(docs: DataFrame, window: int = WINDOW, block: int = BLOCK_TOKENS, end: int = END) -> DataFrame:
    """Sequences of at most ``window`` tokens; one row per piece of a document.

    Takes ``doc_id`` and ``text`` and ignores other columns. Returns doc_id, start, length,
    ids (little-endian unsigned 32-bit), doc_tokens, sequence_id and offset. Every document
    ends with the id ``end``; a null or empty text is that id alone. Rows with a null or
    repeated doc_id are packed like any other. An empty table gives no rows. A full block
    of a long text is a sequence of its own. ``block`` bounds the tokens of remainders that
    a task holds; a single document is held whole.
    """
    doc = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", doc), *T.StructType.fromDDL(PIECE).fields])
    return docs.select("doc_id", "text").mapInArrow(_packer(window, block, end), schema)


def pack_digest(spark, sf_dir: str) -> DataFrame:
    """All documents packed, with a checksum instead of the ids of each piece."""
    from monsoon.llm.common import table

    pieces = pack(table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )
