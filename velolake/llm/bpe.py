"""BPE encoding and decoding, with tree concatenation of long unsplit text."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType
from tokenizers import Tokenizer

from velolake.llm.common import read_table, slices

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
LEAF = 4096            # characters of one pre-token that are encoded at once
LONG_TEXT = 1 << 16    # longer texts are cut into rows that tasks share
CACHED = 1 << 17       # pieces whose ids a task remembers
WINDOW = 8             # tokens on each side of a join that are encoded again at first
# Characters that every version of Unicode puts into the same classes: texts of these alone
# are split alike by any engine of regular expressions.
_OTHER = re.compile("[^\t\n\r -~\u00a1-\u024f]")


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1
    characters stand for themselves, the others follow from U+0100 on in their order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + k) for k, b in enumerate(rest)}


class Codec:
    """Encodes as the tokenizers library does with the file at ``path``; decodes ids to bytes."""

    def __init__(self, path: str, leaf: int = LEAF, cached: int = CACHED, window: int = WINDOW):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.leaf, self.cached, self.window = leaf, cached, window
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        special = {t["id"]: t["content"] for t in file.get("added_tokens", [])}
        self.special = {text: i for i, text in special.items()}
        self.special_or_rest = re.compile(f"({'|'.join(map(re.escape, sorted(self.special, key=len, reverse=True)))})")
        back = {ch: b for b, ch in byte_characters().items()}
        self.bytes_of: dict[int, bytes] = {}
        for text, i in self.tok.get_vocab(with_added_tokens=True).items():
            self.bytes_of[i] = text.encode() if i in special else bytes(back[ch] for ch in text)
        self.cache: dict[str, bytes] = {}
        self.fast = self._fast(file["model"]["merges"])
        self.long_piece = re.compile(f"[^ ]{{{leaf + 1}}}")

    def _fast(self, merges: list) -> tiktoken.Encoding | None:
        """The same merges in tiktoken, several times faster, if ids follow their order."""
        tokens = {i: raw for i, raw in self.bytes_of.items() if i not in self.special.values()}
        back = {ch: bytes([b]) for b, ch in byte_characters().items()}
        for n, merge in enumerate(merges):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            if tokens.get(256 + n) != b"".join(back[ch] for ch in left + right):
                return None
        if sorted(tokens) != list(range(256 + len(merges))):
            return None
        return tiktoken.Encoding("same", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                 mergeable_ranks={raw: i for i, raw in tokens.items()})

    def decode(self, ids: bytes) -> str:
        """Text of little-endian 32-bit ids; bytes that are no UTF-8 become U+FFFD."""
        table = self.bytes_of
        return b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")

    def cut(self, text: str) -> list[str]:
        """Pieces of ``text`` that the pre-tokenizer's expression never joins.

        No token has white space after another character, so every space that follows a
        character other than white space begins a new one, whatever stands around it.
        """
        if "\0" in text:
            return [text]
        parts = text.replace(" ", "\0 ").split("\0")
        if "  " not in text and "\n " not in text and not any(
                p and p[-1].isspace() for p in parts[:-1]):
            return parts
        out = parts[:1]
        for part in parts[1:]:
            if out[-1] and not out[-1][-1].isspace():
                out.append(part)
            else:
                out[-1] += part
        return out

    def segments(self, text: str) -> Iterator[str | int]:
        """Text between special tokens, and the special tokens' ids."""
        for part in self.special_or_rest.split(text) if self.special else [text]:
            if part in self.special:
                yield self.special[part]
            elif part:
                yield part

    def units(self, piece: str) -> Iterator[tuple[str, bool]]:
        """The pre-tokens of a long piece, in byte characters: some at a time, joined by
        spaces, which no byte is written as; and single ones over ``leaf``, marked True."""
        held: list[str] = []
        total = 0
        for mapped, _ in self.tok.pre_tokenizer.pre_tokenize_str(piece):
            if held and total + len(mapped) > self.leaf:
                yield " ".join(held), False
                held, total = [], 0
            if len(mapped) > self.leaf:
                yield mapped, True
            else:
                held.append(mapped)
                total += len(mapped)
        if held:
            yield " ".join(held), False

    def model(self, mapped: str) -> list[int]:
        """Merges of one pre-token, in byte characters."""
        return [t.id for t in self.tok.model.tokenize(mapped)]

    def models(self, unit: str) -> list[int]:
        """Merges of pre-tokens that are joined by spaces, each by itself."""
        return [i for mapped in unit.split(" ") for i in self.model(mapped)]

    def leaves(self, mapped: str) -> list[str]:
        """Halves of halves, until none is longer than a leaf."""
        if len(mapped) <= self.leaf:
            return [mapped]
        mid = len(mapped) // 2
        return self.leaves(mapped[:mid]) + self.leaves(mapped[mid:])

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Ids of the text of ``left`` and ``right`` put together.

        The last and first tokens around the seam are encoded again as one string.  If the
        result begins and ends with the tokens that the two sides have there, every pair of
        neighbours occurs in a valid encoding, which makes the whole valid; otherwise the
        window grows.  A window that reaches the end of a side need not agree there.
        """
        size = self.window
        chars = byte_characters_of(self)
        while True:
            a, b = left[-size:], right[:size]
            new = self.model("".join(chars[i] for i in a + b))
            if (size >= len(left) or new[0] == a[0]) and (size >= len(right) or new[-1] == b[-1]):
                return left[:-size] + new + right[size:]
            size *= 2

    def tree(self, parts: list[list[int]]) -> list[int]:
        """Concatenation of neighbours, level by level."""
        while len(parts) > 1:
            parts = [self.join(parts[k], parts[k + 1]) if k + 1 < len(parts) else parts[k]
                     for k in range(0, len(parts), 2)]
        return parts[0]

    def encode_pieces(self, pieces: list[str]) -> None:
        """Put the ids of pieces that are not cached yet into the cache."""
        new = [p for p in dict.fromkeys(pieces) if p not in self.cache]
        if len(self.cache) + len(new) > self.cached:
            self.cache = {p: self.cache[p] for p in dict.fromkeys(pieces) if p in self.cache}
        short = [p for p in new if len(p) <= self.leaf]
        for piece, e in zip(short, self.tok.encode_batch_fast(short, add_special_tokens=False)):
            self.cache[piece] = np.array(e.ids, "<u4").tobytes()
        for piece in new:
            if len(piece) > self.leaf:
                ids: list[int] = []
                for unit, lone in self.units(piece):
                    ids += self.tree([self.model(x) for x in self.leaves(unit)]) if lone else self.models(unit)
                self.cache[piece] = np.array(ids, "<u4").tobytes()

    def encode(self, text: str | None) -> bytes:
        """Ids of the text as little-endian 32-bit integers."""
        out = []
        for part in self.segments(text or ""):
            if isinstance(part, int):
                out.append(np.array([part], "<u4").tobytes())
                continue
            if self.fast and not _OTHER.search(part) and not self.long_piece.search(part):
                out.append(self.fast.encode_to_numpy(part, disallowed_special=()).astype("<u4", copy=False).tobytes())
                continue
            pieces = self.cut(part)
            self.encode_pieces(pieces)
            out.append(b"".join(map(self.cache.__getitem__, pieces)))
        return b"".join(out)


def byte_characters_of(codec: Codec) -> dict[int, str]:
    """Each id's text in byte characters."""
    if not hasattr(codec, "chars_of"):
        chars = byte_characters()
        codec.chars_of = {i: "".join(chars[b] for b in raw) for i, raw in codec.bytes_of.items()}
    return codec.chars_of


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def rows_of_long_text(coder: Codec, text: str, size: int) -> Iterator[tuple[str, int]]:
    """A long text as (part, kind): kind -1 is plain text, -2 a special token's id in digits,
    -3 are pre-tokens in byte characters, and k >= 0 is a leaf of the k-th pre-token that is
    longer than a leaf."""
    lone = 0
    for part in coder.segments(text):
        if isinstance(part, int):
            yield str(part), -2
            continue
        held: list[str] = []
        total = 0
        for piece in coder.cut(part):
            if held and total + len(piece) > size:
                yield "".join(held), -1
                held, total = [], 0
            if len(piece) <= coder.leaf:
                held.append(piece)
                total += len(piece)
                continue
            if held:
                yield "".join(held), -1
                held, total = [], 0
            for unit, single in coder.units(piece):
                if single:
                    for leaf in coder.leaves(unit):
                        yield leaf, lone
                    lone += 1
                else:
                    yield unit, -3
        if held:
            yield "".join(held), -1


def encode(docs: DataFrame, path: str = TOKENIZER, long_text: int = LONG_TEXT, decoded: bool = False) -> DataFrame:
    """The input's rows in a struct ``row`` with ``ids``, little-endian unsigned 32-bit integers.

    Texts up to ``long_text`` characters are encoded where they are read.  A longer one is
    cut into rows, at places that no token spans, and a pre-token too long for that into
    halves of halves; tasks share these rows, and the parts of one text then meet in one
    group, where the halves are joined level by level.  Only long texts are shuffled.
    ``decoded`` adds ``text_out``, what the ids decode to.

    Nulls and odd input: a null or empty text has no ids; special-token strings in a text
    become their ids, as the library does by default; repeated rows are encoded each; null
    ids and other columns are carried; an empty table gives an empty result.
    """
    names = ["row", "ids", *["text_out"] * decoded]

    def read(coder: Codec, ids: list[bytes]) -> list[pa.Array]:
        return [pa.array([coder.decode(i) for i in ids], pa.string())] if decoded else []

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in slices(batches):
            ids = [coder.encode(t) for t in batch.column("row").field("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(ids, pa.binary()), *read(coder, ids)], names=names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.column("row").slice(k, 1)
                parts = list(rows_of_long_text(coder, row.field("text")[0].as_py(), long_text // 4))
                n = len(parts)
                whole = pa.concat_arrays([row, pa.nulls(n - 1, row.type)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("key")[k].as_py()] * n, pa.int64()), pa.array(range(n), pa.int32()), whole,
                     pa.array([x for x, _ in parts]), pa.array([x for _, x in parts], pa.int32())],
                    names=["key", "seq", "row", "part", "kind"])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            ids = []
            for text, kind in zip(batch.column("part").to_pylist(), batch.column("kind").to_pylist()):
                ids.append(coder.encode(text) if kind == -1 else np.array(
                    [int(text)] if kind == -2 else coder.models(text), "<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("key", "seq", "row", "kind")] + [pa.array(ids, pa.binary())],
                names=["key", "seq", "row", "kind", "ids"])

    def meet(group: pa.Table) -> pa.Table:
        coder = codec(path)
        group = group.sort_by("seq").combine_chunks()
        out: list[bytes] = []
        held: list[list[int]] = []
        last = -1
        for kind, ids in [*zip(group["kind"].to_pylist(), group["ids"].to_pylist()), (-1, b"")]:
            if held and kind != last:
                out.append(np.array(coder.tree(held), "<u4").tobytes())
                held = []
            if kind >= 0:
                held.append(np.frombuffer(ids, "<u4").tolist())
            else:
                out.append(ids)
            last = kind
        ids = [b"".join(out)]
        return pa.table([group["row"].slice(0, 1), pa.array(ids, pa.binary()), *read(coder, ids)], names=names)

    rows = docs.select(F.struct("*").alias("row"))
    made = [StructField("ids", BinaryType()), *[StructField("text_out", StringType())] * decoded]
    result = StructType([rows.schema["row"], *made])
    is_long = F.coalesce(F.length("row.text"), F.lit(0)) > long_text
    near = rows.where(~is_long).mapInArrow(short, result)
    nullable = StructField("row", rows.schema["row"].dataType, True)
    key = [StructField("key", LongType()), StructField("seq", IntegerType()), nullable]
    apart = (rows.where(is_long).select("row", F.monotonically_increasing_id().alias("key"))
             .mapInArrow(cut, StructType([*key, StructField("part", StringType()), StructField("kind", IntegerType())])))
    coded = apart.repartition("key", "seq").mapInArrow(
        parts, StructType([*key, StructField("kind", IntegerType()), StructField("ids", BinaryType())]))
    far = coded.groupBy("key").applyInArrow(meet, StructType([nullable, *made]))
    return near.unionByName(far)


def decode(encoded: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """The rows of ``encode`` with ``text_out``, the text of the ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in slices(batches):
            text = [coder.decode(i) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("ids"), pa.array(text, pa.string())],
                                             names=["row", "ids", "text_out"])

    return encoded.mapInArrow(run, StructType([*encoded.schema.fields, StructField("text_out", StringType())]))


def token_digests(docs: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the decoded text of every row."""
    return encode(docs.select("doc_id", "text"), path, decoded=True).select(
        "row.doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text_out", 256).alias("decoded_sha256"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(read_table(spark, sf_dir, "documents"))
