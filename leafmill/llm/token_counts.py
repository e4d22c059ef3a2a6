"""Token counts with a whole-token shortcut.

Before any text is read, each string of the vocabulary is proved to encode
alone as one token: it must be a single pre-token of its own, and merging its
bytes by rank must end in exactly that token. A text is cut into pre-tokens;
those in the proved set count one, and only the rest are merged. Pre-tokens
depend on nothing before a white-space run or after the run of other
characters that follows it, so such units are counted once and remembered, in
a table of bounded size.

Cases: a null text is empty and counts 0; a text that holds a special token's
string is left to the library, whose default treats it; repeated rows are
counted each.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
REMEMBERED = 300_000


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary's strings, and the byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """``piece`` after merging the adjacent pair of lowest rank, first from the left, until none is left."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, i = min((ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank == 1 << 60:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


class TokenCounter:
    """Counts by one byte-level BPE file; made once for each Python worker."""

    _made: dict[str, "TokenCounter"] = {}

    @classmethod
    def of(cls, path: str) -> "TokenCounter":
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str):
        import tiktoken

        spec = json.load(open(path, encoding="utf-8"))
        self.path, self.library = path, None
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        back = byte_alphabet()
        self.ranks = {bytes(back[c] for c in s): i for s, i in spec["model"]["vocab"].items() if s not in special}
        self.merger = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens={})
        self.cut = regex.compile(PATTERN)
        self.units = re.compile(r"\s*\S+|\s+")
        self.whole = self.prove()
        self.seen: dict[str, int] = {}

    def prove(self) -> frozenset[str]:
        """Vocabulary strings that encode alone as one token."""
        out = set()
        for raw in self.ranks:
            try:
                s = raw.decode("utf-8")
            except UnicodeDecodeError:
                continue  # part of a character: never a pre-token
            if self.cut.findall(s) == [s] and len(self.merger._encode_single_piece(raw)) == 1:
                out.add(s)
        return frozenset(out)

    def of_unit(self, unit: str) -> int:
        n = 0
        for pre in self.cut.findall(unit):
            n += 1 if pre in self.whole else len(self.merger._encode_single_piece(pre.encode("utf-8")))
        return n

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.special is not None and "<|" in text and self.special.search(text):
            if self.library is None:
                from tokenizers import Tokenizer

                self.library = Tokenizer.from_file(self.path)
            return len(self.library.encode(text, add_special_tokens=False).ids)
        units, seen = self.units.findall(text), self.seen
        try:
            return sum(map(seen.__getitem__, units))
        except KeyError:
            pass
        if len(seen) > REMEMBERED:
            seen.clear()
        n = 0
        for u in units:
            k = seen.get(u)
            if k is None:
                k = self.of_unit(u)
                if len(u) <= 64:
                    seen[u] = k
            n += k
        return n


def count_tokens(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", limit: int = 1024) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs``, under the vocabulary file ``tokenizer``."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter.of(tokenizer)
        for b in batches:
            texts = b.column(1).to_pylist()
            n = np.fromiter(map(counter.count, texts), np.int64, len(texts))
            size = np.fromiter((len(t.encode("utf-8")) if t else 0 for t in texts), np.int64, len(texts))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size), pa.array(n), pa.array(n > limit)], names=schema.names)

    return docs.select(doc_id, text).mapInArrow(run, schema)
