"""Token ids as patched frame-of-reference blocks, in files that Spark can read and split.

A shard (one row of the output table) holds the ids of a run of whole or cut
documents: at most ``SHARD_IDS`` ids, cut into blocks of ``BLOCK`` ids. Each
block is stored as

* its minimum,
* a bit width chosen so that ``share`` of the differences to the minimum fit,
* the differences packed at that width (the low bits of larger ones), and
* a list of exceptions: position in the block and the bits above the width.

``index`` holds the byte offset of every block in the payload, so block *i* is
decoded without touching the others. The parts of a document lie in shards
that are numbered by (partition, shard); the table is written in ascending
document order.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paperlake.runtime import cut_lineage, work_dir

from .bytesops import pieces

BLOCK = 128
SHARD_IDS = 1 << 16
SHARE = 0.9
END_ID = 1
WORDS_HELD = 700_000
BYTES_HELD = 64 << 20  # of units and ids: texts without white space are long units
PIECE = 8 << 20  # bytes of text whose distinct words are found together

SHARDS = ("part int, shard int, n_ids int, block int, index binary, payload binary, "
          "doc_ids array<bigint>, doc_rows array<bigint>, doc_first array<int>, doc_n array<int>, doc_ends array<boolean>")


# --- block codec -----------------------------------------------------------

HEAD = 7  # bytes before the exceptions: minimum, width, number of exceptions


def pack_rows(values: np.ndarray, width: int) -> np.ndarray:
    """Low ``width`` bits of each value of each row, least significant bit first, as bytes.

    Rows hold a multiple of eight values; eight of them fill ``width`` bytes.
    """
    rows, n = values.shape
    eights = (values & np.uint64((1 << width) - 1)).reshape(rows, n // 8, 8)
    out = np.zeros((rows, n // 8, width), dtype=np.uint8)
    for byte in range(width):
        for v in range(8 * byte // width, min(8, (8 * byte + 7) // width + 1)):
            shift = v * width - 8 * byte
            part = eights[:, :, v] << np.uint64(shift) if shift >= 0 else eights[:, :, v] >> np.uint64(-shift)
            out[:, :, byte] |= part.astype(np.uint8)
    return out.reshape(rows, n // 8 * width)


def unpack_rows(data: np.ndarray, width: int) -> np.ndarray:
    """Inverse of ``pack_rows``: value v of every eight is read from the 64 bits after its first byte."""
    rows = len(data)
    eights = data.size // width
    held = np.zeros(data.size + 8, dtype=np.uint8)
    held[:data.size] = data.ravel()
    out = np.empty((eights, 8), dtype=np.uint64)
    for v in range(8):
        byte, shift = divmod(v * width, 8)
        out[:, v] = np.ndarray((eights,), dtype="<u8", buffer=held, offset=byte, strides=(width,)) >> np.uint64(shift)
    out &= np.uint64((1 << width) - 1)
    return out.reshape(rows, -1)


def encode(ids: np.ndarray, block: int = BLOCK, share: float = SHARE) -> tuple[bytes, bytes]:
    """Payload and index (little-endian unsigned 32-bit block offsets) of ids below 2^32.

    ``block`` is a multiple of eight. The last block is filled up with its
    last id. All blocks of one width are packed in one numpy call.
    """
    n = len(ids)
    if not n:
        return b"", b""
    count = -(-n // block)
    grid = np.full(count * block, ids[-1], dtype=np.uint64)
    grid[:n] = ids
    grid = grid.reshape(count, block)
    lows = grid.min(axis=1)
    deltas = grid - lows[:, None]
    needed = np.frexp(deltas.astype(np.float64))[1]  # bits of each difference
    rank = min(block - 1, int(share * block))
    widths = np.partition(needed, rank, axis=1)[:, rank]
    parts: list[bytes] = [b""] * count
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        packed = pack_rows(deltas[rows], width) if width else np.zeros((len(rows), 0), dtype=np.uint8)
        odd_row, odd_at = np.nonzero(needed[rows] > width)
        high = (deltas[rows[odd_row], odd_at] >> np.uint64(width)).astype("<u4")
        odd_at, cuts = odd_at.astype("<u2"), np.searchsorted(odd_row, np.arange(len(rows) + 1)).tolist()
        for k, (row, low) in enumerate(zip(rows.tolist(), lows[rows].tolist())):
            i, j = cuts[k], cuts[k + 1]
            parts[row] = b"".join((low.to_bytes(4, "little"), bytes((width,)), (j - i).to_bytes(2, "little"),
                                   odd_at[i:j].tobytes(), high[i:j].tobytes(), packed[k].tobytes()))
    starts = np.concatenate([[0], np.cumsum([len(p) for p in parts[:-1]])]).astype("<u4")
    return b"".join(parts), starts.tobytes()


def decode(payload: bytes, index: bytes, n: int, block: int = BLOCK, first: int = 0, count: int | None = None) -> np.ndarray:
    """Ids ``first`` to ``first + count`` of a shard; only the blocks that hold them are read."""
    count = n - first if count is None else count
    if count <= 0:
        return np.zeros(0, dtype=np.uint32)
    starts = np.frombuffer(index, dtype="<u4").astype(np.int64)
    low, high = first // block, (first + count - 1) // block
    starts = starts[low:high + 1]
    data = np.frombuffer(payload, dtype=np.uint8)
    widths = data[starts + 4]
    odd = data[starts + 5].astype(np.int64) + 256 * data[starts + 6].astype(np.int64)
    bodies = starts + HEAD + 6 * odd
    values = np.zeros((len(starts), block), dtype=np.uint64)
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        if width:
            values[rows] = unpack_rows(data[bodies[rows][:, None] + np.arange(block // 8 * width)], width)
    if odd.any():  # all exceptions at once: the k-th of a block lies 2k bytes, its high bits 2 * odd + 4k bytes after the head
        row = np.repeat(np.arange(len(starts)), odd)
        k = np.arange(len(row)) - np.repeat(np.cumsum(odd) - odd, odd)
        at = starts[row] + HEAD
        places = data[at + 2 * k].astype(np.int64) + 256 * data[at + 2 * k + 1].astype(np.int64)
        at += 2 * odd[row] + 4 * k
        more = sum(data[at + byte].astype(np.uint64) << np.uint64(8 * byte) for byte in range(4))
        values[row, places] |= more << widths[row].astype(np.uint64)
    lows = data[starts[:, None] + np.arange(4)].astype(np.uint64) @ (np.uint64(1) << np.arange(0, 32, 8, dtype=np.uint64))
    ids = (values + lows[:, None]).astype(np.uint32).ravel()
    return ids[first - low * block:first - low * block + count]


# --- tokens ----------------------------------------------------------------

def _spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of the spans ``starts`` to ``starts + lengths``, one after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


class WordIds:
    """Ids of texts, word by word.

    For a tokenizer that drops ASCII white space and lower-cases, the ids of
    a text are those of its words in a row, and a word of letters with
    closing marks has the ids of the small letters and of the marks. The
    distinct words of a piece of texts are found first; letters and marks are
    units, and a unit that is not known yet goes to the tokenizer once. Units
    of ``LETTERS`` are one word to it as they are, so they need its byte
    symbols and merges alone; all others take the whole tokenizer.
    At most ``WORDS_HELD`` units and about ``BYTES_HELD`` bytes, or those of
    one piece if these are more, are remembered; when the store is full only
    those of the piece at hand stay, so memory is bounded and frequent words
    stay.
    """

    # Latin, Greek and Cyrillic letters that NFC leaves alone and whose small form is one letter
    LETTERS = ("A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u012F\u0131-\u024F\u0391-\u03A1\u03A3-\u03CE"
               "\u0400-\u0481\u048A-\u052F\u1E00-\u1EFF")
    WORD = f"^(?P<letters>[{LETTERS}]+)(?P<marks>[.,;:!?]*)$"
    CALL = 50_000  # units in one call

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers import pre_tokenizers as cut

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.closing = np.zeros(max(vocabulary.values()) + 1, dtype=bool)  # ids that end a word
        self.closing[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.of_ascii, self.of_letters = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.of_ascii.normalizer = self.of_letters.normalizer = None
        at_blanks = cut.CharDelimiterSplit(" ")
        self.of_ascii.pre_tokenizer = at_blanks  # ASCII letters are their own byte symbols
        self.of_letters.pre_tokenizer = cut.Sequence([at_blanks, cut.ByteLevel(add_prefix_space=False, use_regex=False)])
        self._keep(pa.array([], pa.string()), np.zeros(0, dtype=np.int64), np.zeros(0, dtype="<u4"))

    def _keep(self, units: pa.Array, lengths: np.ndarray, ids: np.ndarray) -> None:
        self.units, self.lengths, self.ids = units, lengths, ids
        self.starts = np.cumsum(lengths) - lengths

    @classmethod
    def of_worker(cls, path: str) -> "WordIds":
        """The one of this Python worker: Spark reuses workers, and the words stay known from task to task."""
        import tokenizers

        kept = getattr(tokenizers, "_kept_word_ids", None)
        if kept is None or kept[0] != path:
            kept = tokenizers._kept_word_ids = (path, cls(path))
        return kept[1]

    def _encode(self, words: list[bytes]) -> list[bytes]:
        """Any units, in one call cut by the unit that each id begins in: a unit may have no ids or several words."""
        texts = [w.decode("utf-8") for w in words]
        joint = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
        stops = np.cumsum([len(t) + 1 for t in texts])
        at = np.searchsorted(stops, np.array([start for start, _ in joint.offsets], dtype=np.int64), side="right")
        if (at[1:] < at[:-1]).any():
            return self._encode_each(texts)
        data, cuts = np.array(joint.ids, dtype="<u4").tobytes(), (4 * np.searchsorted(at, np.arange(len(texts) + 1))).tolist()
        return [data[i:j] for i, j in zip(cuts, cuts[1:])]

    def _encode_each(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _encode_words(self, texts: list[str], tokenizer) -> tuple[np.ndarray, np.ndarray]:
        """Units that are one word each, in one call cut by the ids that end a word."""
        ids = np.array(tokenizer.encode_batch_fast([" ".join(texts)], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = np.flatnonzero(self.closing[ids]) + 1
        if len(ends) == len(texts) and ends[-1] == len(ids):
            return np.diff(ends, prepend=0), ids
        return _joined(self._encode_each(texts))

    def _learn(self, units: pa.Array) -> np.ndarray:
        """Adds units that are not known yet; returns their rows."""
        words = pc.match_substring_regex(units, f"^[{self.LETTERS}]+$").to_numpy(zero_copy_only=False)
        plain = words & pc.string_is_ascii(units).to_numpy(zero_copy_only=False)
        order, lengths, ids = [], [self.lengths], [self.ids]
        for group, tokenizer in ((plain, self.of_ascii), (words & ~plain, self.of_letters), (~words, None)):
            order.append(np.flatnonzero(group))
            for at in range(0, len(order[-1]), self.CALL):
                texts = units.take(pa.array(order[-1][at:at + self.CALL])).to_pylist()
                n, found = self._encode_words(texts, tokenizer) if tokenizer else _joined(self._encode([t.encode() for t in texts]))
                lengths.append(n), ids.append(found)
        order, rows = np.concatenate(order), np.empty(len(units), dtype=np.int64)
        rows[order] = np.arange(len(self.units), len(self.units) + len(units))
        self._keep(pa.concat_arrays([self.units, units.take(pa.array(order))]), np.concatenate(lengths), np.concatenate(ids))
        return rows

    def _rows(self, units: pa.Array) -> np.ndarray:
        """Rows of distinct units in the store, which learns those it lacks."""
        found = pc.index_in(units, value_set=self.units)
        rows, new = found.fill_null(-1).to_numpy().astype(np.int64), found.is_null().to_numpy(zero_copy_only=False)
        if not new.any():
            return rows
        unknown = units.filter(pa.array(new))
        if len(self.units) + len(unknown) > WORDS_HELD or self.units.nbytes + self.ids.nbytes + unknown.nbytes > BYTES_HELD:
            kept = rows[~new]
            self._keep(self.units.take(pa.array(kept)), self.lengths[kept], self.ids[_spans(self.starts[kept], self.lengths[kept])])
            rows[~new] = np.arange(len(kept))
        rows[new] = self._learn(unknown)
        return rows

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Joined ids of a column of texts without nulls, and the number of ids of each text."""
        lists = pc.ascii_split_whitespace(texts)
        words = lists.flatten().dictionary_encode()
        cut, at = pc.extract_regex(words.dictionary, self.WORD), words.indices.to_numpy()
        letters = pc.if_else(cut.is_valid(), pc.utf8_lower(cut.field(0)), words.dictionary)
        marks = pc.if_else(cut.is_valid(), cut.field(1), "")
        units = pa.concat_arrays([letters, marks]).dictionary_encode()
        rows = self._rows(units.dictionary)[units.indices.to_numpy().reshape(2, -1).T.ravel()]  # letters and marks of each word
        n = self.lengths[rows].reshape(-1, 2).sum(axis=1)
        ids = self.ids[_spans(self.starts[rows], self.lengths[rows])]
        ids = ids[_spans((np.cumsum(n) - n)[at], n[at])]
        ends = np.concatenate([[0], np.cumsum(n[at])])
        counts = pc.list_value_length(lists).to_numpy().astype(np.int64)
        return ids, np.diff(ends[np.concatenate([[0], np.cumsum(counts)])])

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        ids, counts = self.encode_column(pa.array(texts, pa.string()))
        return np.split(ids, np.cumsum(counts))[:-1]


def _joined(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.array([len(p) // 4 for p in parts], dtype=np.int64), np.frombuffer(b"".join(parts), dtype="<u4")


def _shard_writer(path: str, end_id: int, block: int, shard_ids: int, share: float, schema: pa.Schema):
    def run(batches):
        from pyspark import TaskContext

        os_setup()
        part, words = TaskContext.get().partitionId(), WordIds.of_worker(path)
        held, docs, filled, shard = [], [], 0, 0

        def flush():
            nonlocal held, docs, filled, shard
            ids = np.concatenate(held) if held else np.zeros(0, dtype=np.uint32)
            payload, index = encode(ids, block, share)
            row = [part, shard, len(ids), block, index, payload, *map(list, zip(*docs))]
            held, docs, filled, shard = [], [], 0, shard + 1
            return pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(row, schema)], schema=schema)

        row = 0
        for batch in batches:
            for rows, _, _ in pieces(batch, limit=PIECE):
                found, counts = words.encode_column(rows.column("text").cast(pa.string()).fill_null(""))
                found, first = np.insert(found, np.cumsum(counts), end_id), 0
                for doc_id, n in zip(rows.column("doc_id").to_pylist(), (counts + 1).tolist()):
                    ids, at, first = found[first:first + n], 0, first + n
                    while at < len(ids):
                        take = min(len(ids) - at, shard_ids - filled)
                        held.append(ids[at:at + take])
                        docs.append((doc_id, row, filled, take, at + take == len(ids)))
                        filled, at = filled + take, at + take
                        if filled == shard_ids:
                            yield flush()
                    row += 1
        if docs:
            yield flush()

    return run


def os_setup() -> None:
    """One thread a task: Spark already runs one task per core."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"


def write_shards(docs: DataFrame, tokenizer_path: str, target: str, end_id: int = END_ID, block: int = BLOCK,
                 shard_ids: int = SHARD_IDS, share: float = SHARE) -> None:
    """Encodes ``docs`` (doc_id, text) in ascending doc_id order and writes the shards as Parquet below ``target``.

    A null text is an empty one (its ids are the end id alone); null doc_ids
    come first. Rows with the same doc_id are each kept, in the order of the
    hash of their text. Extra columns are ignored. An empty table writes no
    shard. A range partition never depends on one key alone, as the text's
    hash breaks ties. The tokenizer must ignore ASCII white space and treat
    the words between it alone.
    """
    tie = F.xxhash64("text")
    ordered = (docs.select(F.col("doc_id").cast("long"), F.col("text"), tie.alias("_tie"))
               .repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("_tie"))
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("_tie")).drop("_tie"))
    schema = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("n_ids", pa.int32()), ("block", pa.int32()),
                        ("index", pa.binary()), ("payload", pa.binary()), ("doc_ids", pa.list_(pa.int64())),
                        ("doc_rows", pa.list_(pa.int64())), ("doc_first", pa.list_(pa.int32())),
                        ("doc_n", pa.list_(pa.int32())), ("doc_ends", pa.list_(pa.bool_()))])
    ordered.mapInArrow(_shard_writer(tokenizer_path, end_id, block, shard_ids, share, schema), SHARDS).write.parquet(target)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHARDS).parquet(path)


def shard_offsets(shards: DataFrame) -> DataFrame:
    """First id of every shard in the whole stream: (part, shard, before).

    Only counts are moved: one row per partition is summed in order, and the
    shards of a partition follow from that.
    """
    counts = shards.select("part", "shard", F.col("n_ids").cast("long").alias("n"))
    parts = counts.groupBy("part").agg(F.sum("n").alias("n"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inner = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    return (counts.withColumn("inner", F.coalesce(F.sum("n").over(inner), F.lit(0)))
            .join(base, "part").select("part", "shard", (F.col("base") + F.col("inner")).alias("before")))


PIECES = "part int, shard int, row bigint, doc_id bigint, first int, n int, ends boolean, crc bigint"


def _decoded(batches):
    for batch in batches:
        rows = batch.to_pylist()
        out = {k: [] for k in ("part", "shard", "row", "doc_id", "first", "n", "ends", "crc")}
        for r in rows:
            for doc_id, row, first, n, ends in zip(r["doc_ids"], r["doc_rows"], r["doc_first"], r["doc_n"], r["doc_ends"]):
                # whole documents by their own blocks; the stream stays encoded
                out["doc_id"].append(doc_id), out["row"].append(row), out["first"].append(first), out["n"].append(n)
                out["ends"].append(ends), out["part"].append(r["part"]), out["shard"].append(r["shard"])
            ids = decode(r["payload"], r["index"], r["n_ids"], r["block"]).astype("<u4")
            out["crc"] += [zlib.crc32(ids[f:f + n].tobytes()) for f, n in zip(r["doc_first"], r["doc_n"])]
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(v, type=t) for v, t in zip(out.values(), kinds)], names=list(out))


def _times(m: list[int], v: int) -> int:
    out, i = 0, 0
    while v:
        if v & 1:
            out ^= m[i]
        v, i = v >> 1, i + 1
    return out


@lru_cache(maxsize=64)
def _zero_bits(power: int) -> list[int]:
    """The matrix that shifts a checksum by 2^power zero bits; its column i is the image of bit i."""
    if not power:
        return [0xEDB88320] + [1 << i for i in range(31)]
    half = _zero_bits(power - 1)
    return [_times(half, x) for x in half]


def crc_joined(first: int, second: int, length: int) -> int:
    """crc32 of two byte strings in a row, from the crc of each and the length of the second."""
    bits = 8 * length
    for power in range(bits.bit_length()):
        if bits >> power & 1:
            first = _times(_zero_bits(power), first)
    return first ^ second


def _fold_crc(pieces) -> int:
    out = 0
    for p in pieces:
        out = crc_joined(out, p["crc"], 4 * p["n"])
    return out


def document_index(shards: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32.

    A document cut by a shard border has one piece per shard; only such
    pieces are brought together, and their checksums are joined.
    """
    parts = cut_lineage(shards.mapInArrow(_decoded, PIECES), "pieces").join(shard_offsets(shards), ["part", "shard"])
    at = F.col("before") + F.col("first")
    whole = (F.col("row") == F.col("row")) & F.col("ends") & (F.col("first") > 0)
    single = parts.filter(whole).select("doc_id", at.alias("start"), F.col("n").cast("long").alias("n_tokens"),
                                        F.col("crc").alias("ids_crc32"))
    fold = F.udf(_fold_crc, "bigint")
    cut = (parts.filter(~whole).groupBy("part", "row")
           .agg(F.first("doc_id").alias("doc_id"), F.min(at).alias("start"), F.sum("n").cast("long").alias("n_tokens"),
                F.sort_array(F.collect_list(F.struct("shard", "n", "crc"))).alias("_p"))
           .select("doc_id", "start", "n_tokens", fold("_p").alias("ids_crc32")))
    return single.unionByName(cut)


def token_file(docs: DataFrame, tokenizer_path: str, target: str | None = None, **kw) -> DataFrame:
    """Writes the files and returns the per-document index read back from them."""
    target = target or work_dir(docs.sparkSession, "tokens")
    write_shards(docs, tokenizer_path, target, **kw)
    return document_index(read_shards(docs.sparkSession, target))
