"""Token ids in ORC files: sorted by document id, readable by stripe, pruned by metadata.

A file holds rows (doc_id, seq, ids). ORC run-length-encodes the ids, keeps row indexes
every `stride` rows and a Bloom filter on doc_id in each, so that a reader looking for a
document skips stripes and row groups by minimum, maximum and filter, and a scan splits
files by stripe.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallyhall.session import saved

# Texts are encoded together until they have so many characters.
FLUSH_CHARS = 1 << 20
# A worker forgets the pieces that it has encoded beyond so many (some 200 MB); they are encoded again when met again.
MEMO_PIECES = 1_500_000
# The byte-level pattern of the tokenizer never joins characters across these places: before a single space
# between two characters that are not blank.
_CUT = re.compile(r"(?<=\S) (?=\S)")
# Blanks other than space and line feed.
_ODD = "".join(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")
_PLAIN_ODD = [c for c in _ODD if c.isascii()]
_RUNS = ("  ", "\n\n", " \n", "\n ")
# Words of Latin letters, marks behind them or not, a line feed before them or not; so many are encoded at once.
TOGETHER = 64
_WORD = re.compile(r"\n?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+[!#$%&*,.:;?|]*")
_memos: dict[str, "PieceMemo"] = {}
# Characters of a text that range rows of one id; the driver samples them.
BEGINNING = 64



def _letters() -> dict[int, str]:
    """The characters that byte-level tokenizers write bytes as: printable bytes as themselves, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + n) for n, b in enumerate(others)}


class PieceMemo(dict):
    """Piece of text -> its ids as little-endian unsigned 32-bit integers, encoded when first met.

    A byte-level BPE tokenizer cuts text by a pattern and encodes each cut alone, so the ids
    of a text are those of its pieces in order, whatever the pieces, if they end at such cuts.
    A key is a word after a space, a line feed with the word after it, or, marked by a carriage return,
    the word at the beginning of a text. Texts with other blanks or runs of them are cut with care, into
    pieces that are kept under a carriage return too.

    Words not met before are encoded many at once. The model merges bytes by rank; if no token
    that such words could give has a blank within or a letter beside a mark, it can't merge
    across them, and gives their ids one after another.

    Added tokens in a text, <|endoftext|> for one, are single ids, as in the tokenizer's own encode().
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # The tokenizer takes out its added tokens before all else, and encodes what stands between them by itself.
        self.added = {t.content: t for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.plain = not any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in self.added.values())
        listed = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, listed)) + ")") if listed else None
        self.model = self.tokenizer.model
        self.letters = _letters()
        self.new: set[str] = set()
        tokens = self.tokenizer.get_vocab(with_added_tokens=False)
        letter = "A-Za-z" + re.escape("".join(self.letters[b] for b in (*range(0x80, 0xC0), *range(0xC3, 0xCA))))
        own = re.compile(f"[{letter}!#$%&*,.:;?|ĠĊ]+")
        across = re.compile(f".[ĠĊ]|[!#$%&*,.:;?|][{letter}]|[{letter}][!#$%&*,.:;?|]")
        self.apart = not any(across.search(t) for t in tokens if own.fullmatch(t) and t.strip("ĠĊ"))
        self.first = {c: np.zeros(max(tokens.values()) + 1, bool) for c in "ĠĊ"}
        for token, n in tokens.items():
            if token[0] in self.first:
                self.first[token[0]][n] = True

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        pieces, ends = [], []
        for text in texts:
            pieces += self.cut_pieces(text)
            ends.append(len(pieces))
        found = list(map(self.__getitem__, pieces))
        if self.new:
            self.learn(self.new)
            self.new = set()
            found = [ids if ids.__class__ is bytes else self[ids] for ids in found]
        return [b"".join(found[a:z]) for a, z in zip([0, *ends], ends)]

    def __missing__(self, piece: str) -> str:
        """The piece itself stands for its ids until it is learned."""
        self.new.add(piece)
        return piece

    def cut_pieces(self, text: str) -> list[str]:
        """The text's pieces; an added token is one, as the tokenizer has it."""
        if self.cut is None:
            return self.pieces(text)
        if not self.plain:  # such tokens reach beyond their own characters, and may be found in changed text
            return ["\r" + text]
        if not any(content in text for content in self.added):
            return self.pieces(text)
        out = []
        for part in self.cut.split(text):
            if part:
                out += ["\r" + part] if part in self.added else self.pieces(part)
        return out

    @staticmethod
    def pieces(text: str) -> list[str]:
        odd = _PLAIN_ODD if text.isascii() else _ODD
        if text[:1] in " \n" or text[-1:] in " \n" or any(run in text for run in _RUNS) or any(c in text for c in odd):
            first, *rest = _CUT.split(text)
            return ["\r" + first, *["\r " + piece for piece in rest]]
        found = text.replace("\n", " \n").split(" ")
        found[0] = "\r" + found[0]
        return found

    def learn(self, pieces: set[str]) -> None:
        """Encode pieces that aren't known yet."""
        kinds = {"Ġ": [], "Ċ": []}
        for piece in pieces:
            if self.apart and _WORD.fullmatch(piece):
                kinds["Ċ" if piece[0] == "\n" else "Ġ"].append(piece)
            else:
                whole = piece[1:] if piece[:1] == "\r" else piece if piece[:1] == "\n" else " " + piece
                self[piece] = array("I", self.tokenizer.encode(whole, add_special_tokens=False).ids).tobytes()
        for mark, words in kinds.items():
            between = "" if mark == "Ċ" else " "
            for at in range(0, len(words), TOGETHER):
                some = words[at : at + TOGETHER]
                written = (between + between.join(some)).encode().decode("latin-1").translate(self.letters)
                ids = np.array([token.id for token in self.model.tokenize(written)], dtype="<u4")
                starts = np.flatnonzero(self.first[mark][ids]) * 4
                if len(starts) != len(some):
                    raise ValueError("the tokenizer's model joined words")
                blob, edges = ids.tobytes(), [*starts.tolist(), 4 * len(ids)]
                self.update((w, blob[a:z]) for w, a, z in zip(some, edges, edges[1:]))


def _memo(path: str) -> PieceMemo:
    memo = _memos.get(path)
    if memo is None:
        memo = _memos[path] = PieceMemo(path)
    if len(memo) > MEMO_PIECES:
        memo.clear()
    return memo


def _id_lists(blobs: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(b) // 4 for b in blobs)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(blobs), dtype="<i4")))


def _encoder(path: str, end_id: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        closing, seq = array("I", [end_id]).tobytes(), 0

        def flushed(keys: list, texts: list[str]) -> pa.RecordBatch:
            nonlocal seq
            blobs = [ids + closing for ids in _memo(path).encode_all(texts)]
            out = pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(range(seq, seq + len(keys)), pa.int64()), _id_lists(blobs)],
                names=["doc_id", "seq", "ids"],
            )
            seq += len(keys)
            return out

        for batch in batches:
            keys, texts, size = [], [], 0
            for key, text in zip(batch.column(0), batch.column(1)):
                keys.append(key.as_py())
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size >= FLUSH_CHARS:
                    yield flushed(keys, texts)
                    keys, texts, size = [], [], 0
            if keys:
                yield flushed(keys, texts)

    return encode


def write_token_orc(
    docs: DataFrame, out: str, tokenizer: str, end_id: int = 0, id_column: str = "doc_id", text_column: str = "text",
    stride: int = 1000, stripe_bytes: int = 16 << 20,
) -> None:
    """Encode every text and write its ids, documents in ascending order of id over all files.

    The texts, not the ids, are ranged by document id: they are the smaller of the two in a
    shuffle. Missing ids come first, missing text is empty, rows of one id are ordered by
    text. An id that many rows repeat or lack is split by how its texts begin. Other columns
    are ignored. `tokenizer` is a path that every executor sees.
    """
    thin = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    ranged = thin.repartitionByRange("doc_id", F.substring("text", 1, BEGINNING)).sortWithinPartitions("doc_id", "text")
    ids = ranged.mapInArrow(_encoder(tokenizer, end_id), "doc_id long, seq long, ids array<int>")
    (
        ids.write.option("compression", "lz4")
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.row.index.stride", str(stride))
        .option("orc.stripe.size", str(stripe_bytes))
        .orc(out)
    )


def read_token_orc(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, seq (row within its file), ids; filters on doc_id are pushed into the files."""
    return spark.read.schema("doc_id long, seq long, ids array<int>").orc(path)


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(3)
        ends = lists.offsets.to_numpy()
        values = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
        sums = [zlib.crc32(values[a:b].data) for a, b in zip(ends[:-1], ends[1:])]
        counts = pa.array(np.diff(ends).astype(np.int64))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], counts, pa.array(sums, pa.int64())],
            names=["file", "doc_id", "seq", "n_tokens", "ids_crc32"],
        )


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, from the files alone.

    Running sums stay within a file; only the files' totals, one row each, are summed across. The ids are
    read once: lengths and checksums, a few bytes a document, are written for the two that need them.
    """
    rows = read_token_orc(spark, path).select(
        F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("int").alias("file"), "doc_id", "seq", "ids"
    )
    sums = saved(rows.mapInArrow(_checksums, "file int, doc_id long, seq long, n_tokens long, ids_crc32 long"))
    own = Window.partitionBy("file").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    placed = sums.select("*", F.coalesce(F.sum("n_tokens").over(own), F.lit(0)).alias("own"))
    totals = sums.groupBy("file").agg(F.sum("n_tokens").alias("total"))
    offsets = totals.select("file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))
    return placed.join(offsets, "file").select("doc_id", (F.col("offset") + F.col("own")).alias("start"), "n_tokens", "ids_crc32")
