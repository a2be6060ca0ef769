"""BPE encoding and decoding with a pair occurrence index.

The words of a batch are laid out in one symbol array with links to the next and previous symbol. The index maps
each mergeable pair (by its rank) to all its positions in that array. Active ranks are applied in ascending order;
each merge updates the position lists of the pairs it makes. A word is encoded once for all its occurrences.

Reads ``tokenizer.json`` files of byte-level BPE (no normaliser, GPT-2 pattern, no added prefix space).
"""

from __future__ import annotations

import ctypes
import gc
import heapq
import json
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from docgeo.llm.common import map_arrow, slices

# Fixed value: the pre-tokeniser pattern of byte-level BPE files with ``use_regex``.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Distinct words kept encoded in a worker; beyond it the memo starts anew (memory only, results are the same).
MEMO_WORDS = 1 << 17

# Bytes of text whose words are merged through one index.
BLOCK_BYTES = 4 << 20

# A pair with so many positions is merged at all of them by vector operations.
VECTOR_FROM = 24

_GONE, _EDGE = -2, -1


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if printable in Latin-1, else the next one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class PairIndexBpe:
    """The vocabulary of a tokeniser file and the merge procedure."""

    def __init__(self, spec: str) -> None:
        data = json.loads(spec)
        model, chars = data["model"], byte_characters()
        pre = data.get("pre_tokenizer") or {}
        if model.get("type", "BPE") != "BPE" or data.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError("only byte-level BPE without normaliser and prefix space is supported")
        vocab: dict[str, int] = model["vocab"]
        self.byte_id = np.array([vocab[c] for c in chars], dtype=np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.left = [vocab[a] for a, _ in merges]
        self.right = [vocab[b] for _, b in merges]
        self.made = [vocab[a + b] for a, b in merges]
        self.base = 1 + max(max(vocab.values()), *(t["id"] for t in data.get("added_tokens", [])), 0)
        keys = [a * self.base + b for a, b in zip(self.left, self.right, strict=True)]
        self.rank_of = {k: r for r, k in enumerate(keys)}
        born = {m: r for r, m in enumerate(self.made)}
        if len(born) < len(merges) or any(max(born.get(a, -1), born.get(b, -1)) >= r for r, (a, b) in enumerate(zip(self.left, self.right, strict=True))):
            # ascending ranks over the whole index equal each word's own order only if merges use earlier tokens
            raise ValueError("a merge uses a token made by a later merge")
        order = np.argsort(np.array(keys, dtype=np.int64))
        self.sorted_keys, self.sorted_ranks = np.array(keys, dtype=np.int64)[order], order
        back = {c: b for b, c in enumerate(chars)}
        self.bytes_of: dict[int, bytes] = {i: bytes(back[c] for c in t) for t, i in vocab.items()}
        self.added = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        for t in data.get("added_tokens", []):
            if t.get("lstrip") or t.get("rstrip") or t.get("single_word"):
                raise ValueError("added tokens that strip or match single words are not supported")
            self.bytes_of[t["id"]] = t["content"].encode()
        self.split_added = regex.compile("|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True))) if self.added else None
        self.find_words = regex.compile(PATTERN).findall
        self.number: defaultdict[str, int] = defaultdict()  # the words met, in this order
        self.packed: list[bytes] = []  # their ids

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word (little-endian unsigned 32-bit), all merged together through one pair index."""
        if not words:
            return []
        raw = [w.encode() for w in words]
        flat = np.frombuffer(b"".join(raw), dtype=np.uint8)
        sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        n = int(sizes.sum()) + len(raw) + 1  # an edge before, between and after the words
        symbols = np.full(n, _EDGE, dtype=np.int64)
        symbols[np.arange(len(flat)) + np.repeat(np.arange(1, len(raw) + 1), sizes)] = self.byte_id[flat]

        def ranks(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            keys = np.where((a >= 0) & (b >= 0), a * self.base + b, -1)
            at = np.minimum(np.searchsorted(self.sorted_keys, keys), len(self.sorted_keys) - 1)
            where = np.flatnonzero(self.sorted_keys[at] == keys)
            return where, self.sorted_ranks[at[where]]

        where, found = ranks(symbols[:-1], symbols[1:])
        order = np.argsort(found, kind="stable")
        where, found = where[order], found[order]
        cuts = np.flatnonzero(np.diff(found)) + 1
        index: dict[int, list[int]] = {int(found[s]): where[s:e].tolist() for s, e in zip([0, *cuts], [*cuts, len(found)], strict=True)} if len(found) else {}
        # the same memory as arrays (rare pairs, one position at a time) and as vectors (common pairs, all at once)
        sym, nxt, prv = array("q", symbols.tobytes()), array("q", range(1, n + 1)), array("q", range(-1, n - 1))
        sym_v, nxt_v, prv_v = (np.frombuffer(x, dtype=np.int64) for x in (sym, nxt, prv))
        active = list(index)
        heapq.heapify(active)
        rank_of, base = self.rank_of.get, self.base

        def listed(r: int, i: int) -> None:
            if r in index:
                index[r].append(i)
            else:
                index[r] = [i]
                heapq.heappush(active, r)

        while active:
            rank = heapq.heappop(active)
            positions = index.pop(rank)
            a, b, new = self.left[rank], self.right[rank], self.made[rank]
            if len(positions) >= VECTOR_FROM and a != b:
                i = np.sort(np.array(positions, dtype=np.int64))
                i = i[(sym_v[i] == a) & (np.diff(i, prepend=-1) > 0)]
                i = i[sym_v[nxt_v[i]] == b]
                j = nxt_v[i]
                k = nxt_v[j]
                sym_v[i], sym_v[j], nxt_v[i], prv_v[k] = new, _GONE, k, i
                p = prv_v[i]  # after the links are updated: pairs of two merged neighbours are seen as such
                for start, (x, y) in ((p, (sym_v[p], sym_v[i])), (i, (sym_v[i], sym_v[k]))):
                    where, found = ranks(x, y)
                    for r, q in zip(found.tolist(), start[where].tolist(), strict=True):
                        listed(r, q)
                continue
            positions.sort()  # left to right, so that of overlapping pairs the first wins
            for i in positions:
                if sym[i] != a or sym[j := nxt[i]] != b:
                    continue  # merged away since it was listed
                k, p = nxt[j], prv[i]
                sym[i], sym[j], nxt[i], prv[k] = new, _GONE, k, i
                if sym[p] >= 0 and (r := rank_of(sym[p] * base + new)) is not None:
                    listed(r, p)
                if sym[k] >= 0 and (r := rank_of(new * base + sym[k])) is not None:
                    listed(r, i)
        out = sym_v[sym_v != _GONE]
        edges = np.flatnonzero(out == _EDGE)
        packed = out.astype("<u4").tobytes()
        return [packed[4 * (s + 1) : 4 * e] for s, e in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]

    def parts(self, text: str) -> list[tuple[str, int | None]]:
        """Stretches of plain text and added tokens (with their id), in order."""
        if self.split_added is None or not any(t in text for t in self.added):
            return [(text, None)]
        out, at = [], 0
        for m in self.split_added.finditer(text):
            out += [(text[at : m.start()], None), (m.group(), self.added[m.group()])]
            at = m.end()
        return [*out, (text[at:], None)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The packed ids of each text; the new words of all texts are merged together."""
        if len(self.number) > MEMO_WORDS:
            self.number.clear()
            self.packed.clear()
        number = self.number
        number.default_factory = number.__len__
        split = []
        for t in texts:
            parts = []
            for s, i in self.parts(t):
                parts.append((np.fromiter(map(number.__getitem__, self.find_words(s)), dtype=np.int32) if i is None else None, i))
            split.append(parts)
        self.packed += self.encode_words(list(islice(number, len(self.packed), None)))
        get = self.packed.__getitem__
        return [b"".join(b"".join(map(get, words.tolist())) if i is None else i.to_bytes(4, "little") for words, i in parts) for parts in split]

    def decode(self, packed: bytes) -> str:
        """Text of the ids, special tokens kept; bytes that are not UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(packed, dtype="<u4").tolist())).decode("utf-8", "replace")


def give_back_memory() -> None:
    """Hand what this worker freed in earlier stages back to the system: workers are used again, and keep it else."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library than glibc
        pass


def bpe_encode_decode(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every whole text and decode its ids again: ``key, token_ids, decoded``.

    ``token_ids`` is BINARY, the ids as little-endian unsigned 32-bit integers; ``decoded`` is the text made from them.
    A null or empty text has no ids and decodes to the empty text. Repeated rows and null keys give one row each; other
    columns of ``docs`` are not read. The tokeniser file is read on the driver and broadcast (the file's size, about
    1.5 MB, does not depend on the data). No shuffle: each partition encodes its rows, and a lost task is simply run again.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back_memory()
        bpe = PairIndexBpe(spec.value)
        for batch in batches:
            for part in slices(batch, "text", BLOCK_BYTES):
                ids = bpe.encode([t or "" for t in part.column(1).to_pylist()])
                out = pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], names=[key, "token_ids"])
                for some in slices(out, "token_ids"):
                    yield some.append_column("decoded", pa.array(map(bpe.decode, some.column(1).to_pylist()), pa.string()))

    rows = docs.select(docs[key], docs[text].cast("string").alias("text"))
    return map_arrow(rows, run, f"{key} {docs.schema[key].dataType.simpleString()}, token_ids binary, decoded string")
