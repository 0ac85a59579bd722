"""Token ids of whole texts by the tokenizers library, each distinct piece encoded once.

Byte-level BPE never merges across the matches of its split pattern, and no match holds a
non-space character followed by white space. So a text may be cut before any white space
that follows something else, the pieces encoded one by one, and the ids put together: the
same ids, while a piece that occurs a thousand times is encoded once.
"""

from __future__ import annotations

import base64
import os
import re
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from lotwise.llm.common import kept, map_arrow

# Pieces remembered per worker, about 200 bytes each, in each of two generations: a memory
# that is full becomes the old one, from which pieces in use are taken over.
REMEMBERED = 500_000
# Where a cut at each space, line end, full stop and comma would part a run: white space before
# white space, or anything but a Latin letter or ASCII digit before a stop or comma.
RUN = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}][ \n]"
    r"|(?:^|[^A-Za-z0-9À-ÖØ-öø-ɏ])[.,]"
)
CUT = re.compile(r"(?<=\S)(?=[ \t\n\r\f\v])")
# Texts of ASCII and Latin letters alone, and the matches of the split pattern in them.
PLAIN = re.compile(r"[\x00-\x7FÀ-ÖØ-öø-ɏ]*")
MATCH = re.compile(
    r"'(?:s|t|re|ve|m|ll|d)| ?[A-Za-zÀ-ÖØ-öø-ɏ]+| ?[0-9]+| ?[^\sA-Za-z0-9À-ÖØ-öø-ɏ]+|\s+(?!\S)|\s+", re.ASCII
)
# Characters that operators take up at once, and that one encoder does.
BATCH_CHARS = 1 << 20
ENCODED_CHARS = 1 << 22


def load(path: str):
    """A tokenizer from its JSON file; special tokens' names in a text are ordinary text."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte: itself if it prints, else one from 256 on."""
    printing = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(printing)]
    return {b: chr(b) for b in printing} | {b: chr(256 + i) for i, b in enumerate(others)}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def last_merge(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The two parts whose merge gives ``token``, when only earlier ranks are merged before."""
    parts = [token[i : i + 1] for i in range(len(token))]
    limit = ranks[token]
    while len(parts) > 2:
        rank, at = min((ranks.get(a + b, limit), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank >= limit:
            raise ValueError(f"no merge leads to {token!r}")
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts[0], parts[1]


def from_ranks(path: str, pattern: str):
    """A tokenizer of the library with the vocabulary and merge order of a rank file."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    ranks, char = read_ranks(path), byte_characters()
    spell = {token: "".join(char[b] for b in token) for token in ranks}
    merges = [
        tuple(spell[part] for part in last_merge(token, ranks))
        for token in sorted(ranks, key=ranks.get)
        if len(token) > 1
    ]
    model = models.BPE({spell[t]: rank for t, rank in ranks.items()}, merges, ignore_merges=True)
    tokenizer = Tokenizer(model)
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
        [
            pre_tokenizers.Split(Regex(pattern), behavior="isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ]
    )
    return tokenizer


def marked(text: str, runs: bool) -> str | None:
    """The text with a zero byte before white space that follows something else, and, if there are
    no runs of such, before stops and commas: no match goes from a letter or digit to what is
    neither. None if the text has zero bytes of its own."""
    if "\0" in text:
        return None
    if runs:
        return CUT.sub("\0", text)
    return text.replace(" ", "\0 ").replace("\n", "\0\n").replace(",", "\0,").replace(".", "\0.")


class Memory:
    """What the last so many different keys stood for, in two generations."""

    def __init__(self, most: int):
        self.most, self.now, self.old = most, {}, {}

    def unknown(self, keys: set[str]) -> set[str]:
        """The keys that are in neither generation; all others are in ``now`` afterwards."""
        new = keys.difference(self.now)
        if len(self.now) + len(new) > self.most:
            self.now, self.old, new = {}, self.now, keys
        again = new.intersection(self.old) if self.old else ()
        for key in again:
            self.now[key] = self.old[key]
        return new.difference(again)


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, tokenizer, remembered: int = REMEMBERED):
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.spelling = {b: char for b, char in byte_characters().items() if char != chr(b)}
        self.pieces = Memory(remembered)

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [_packed(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: set[str]) -> None:
        """Plain pieces are matched here and given to the library's model match by match, spelled
        in its characters for bytes; all others go through the whole library."""
        known, tokenize, spelling = self.pieces.now, self.model.tokenize, self.spelling
        space, others = spelling[ord(" ")], []
        for piece in new:
            if not PLAIN.fullmatch(piece):
                others.append(piece)
                continue
            if piece.isascii() and piece.isprintable():
                spelled = [match.replace(" ", space) for match in MATCH.findall(piece)]
            else:
                spelled = [match.encode().decode("latin-1").translate(spelling) for match in MATCH.findall(piece)]
            known[piece] = _packed([token.id for match in spelled for token in tokenize(match)])
        known.update(zip(others, self._whole(others)))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Arrow cuts the texts and numbers their distinct pieces; only these are looked up."""
        runs = pc.match_substring_regex(pa.array(texts, pa.large_string()), RUN).to_pylist()
        cut = pc.split_pattern(pa.array(map(marked, texts, runs), pa.large_string()), "\0")
        bounds, numbered = cut.offsets, cut.values.dictionary_encode()
        # The pieces one by one take more than the texts: they go before others are learnt.
        del runs, cut
        distinct, numbers = numbered.dictionary.to_pylist(), numbered.indices
        del numbered
        self._learn(self.pieces.unknown(set(distinct)))
        known = self.pieces.now
        ids = pa.array([known[piece] for piece in distinct], pa.large_binary()).take(numbers)
        del distinct, numbers
        _, ends, data = ids.buffers()
        at = np.frombuffer(ends, np.int64)[bounds.to_numpy()].tolist()
        every = memoryview(data or b"")
        out = [every[begin:end].tobytes() for begin, end in zip(at, at[1:])]
        own = [i for i, text in enumerate(texts) if "\0" in text]
        for i, whole in zip(own, self._whole([texts[i] for i in own])):
            out[i] = whole
        return out


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def encoder(path: str, pattern: str | None = None) -> Encoder:
    """This worker's encoder for a JSON file, or for a rank file and its split pattern."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    # Decoding has workers of its own beside the encoder's: half the memory is left for pieces.
    build = (lambda: Encoder(load(path))) if pattern is None else (lambda: Encoder(from_ranks(path, pattern), REMEMBERED // 2))
    return kept(("encoder", path, pattern), build)


def slices(texts: list[str], chars: int = BATCH_CHARS, most: int = 500):
    """Index ranges of at most so many texts and, beyond the first, so many characters."""
    start = 0
    while start < len(texts):
        end, size = start, 0
        while end < len(texts) and end - start < most and (end == start or size + len(texts[end]) <= chars):
            size += len(texts[end])
            end += 1
        yield start, end
        start = end


def end_marked(ids: bytes, end_id: int) -> bytes:
    return ids + end_id.to_bytes(4, "little")


def encoded(docs: DataFrame, path: str, end_id: int | None = None) -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian unsigned 32-bit) of every row; null text is empty."""

    def run(batches):
        encode = encoder(path).encode
        for batch in batches:
            doc_ids = batch.column(0)
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for lo, hi in slices(texts, ENCODED_CHARS, 2000):
                ids = encode(texts[lo:hi])
                if end_id is not None:
                    ids = [end_marked(i, end_id) for i in ids]
                yield pa.RecordBatch.from_arrays([doc_ids.slice(lo, hi - lo), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id bigint, ids binary", remembers=True)
