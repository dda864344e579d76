"""BPE encoding and decoding of whole texts by a prefix-sharing trie.

For tokenizer files of the kind "BPE with word ends": NFC, white space, lower
case; a pattern that cuts words; byte-level symbols; merges with a word-end
suffix on the last symbol. A text is cut at white space (the pattern never
crosses it), and the different words that a task has not met yet form a trie. It
is held as the sorted words: going through them is the depth-first walk, and what
a word has in common with the one before is the part of the path that both share.
The walk gives every node, that is every prefix, the last token of its encoding:
the one vocabulary entry that ends the prefix and may follow the last token of
the prefix before it. Each prefix is computed once, whatever the number of words
that begin with it; a word's tokens are read off its path.

Two tokens may follow one another if the merges turn their joined symbols back
into these two; a sequence is the BPE encoding if that holds for all neighbours.

Decoding starts from the ids: each id's token is looked up and they are joined.

Scale: no shuffle. Texts stream through the tasks; what a task keeps of words is
bounded in number and bytes (``CACHED_CHUNKS``, ``CACHED_BYTES``, ``MAX_PAIRS``), a
full store starts anew, and it is dropped at the task's end. The vocabulary file is read once by the driver and sent as it is: its size is checked
against ``MAX_FILE_BYTES``.

Defined results: a null or empty text, or one of white space alone, has no
tokens; strings of added tokens in a text become these tokens; rows that repeat
an id are encoded each; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.textbytes import NONSPACE, give_back, prefix_hash, ranges, slices, span_hash, word_spans

MAX_FILE_BYTES = 64 << 20
CACHED_CHUNKS = 400_000
CACHED_BYTES = 96 << 20
MAX_PAIRS = 300_000
_SLICE = 1 << 20  # bytes of text encoded at once
#: What the files' patterns mean by white space (fixed values).
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_BASE = (-1, "", "")
_END = "\ue000"  # no byte symbol
_SEPARATORS = regex.compile("[\x1c-\x1f]")
_SPACES = regex.compile(f"[{SPACE}]+")


def byte_symbols() -> list[str]:
    """One visible character for each byte: itself if it is printable Latin-1, else the next one from 256 on."""
    out, extra = [], 256
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or 174 <= byte <= 255:
            out.append(chr(byte))
        else:
            out.append(chr(extra))
            extra += 1
    return out


class TrieEncoder:
    def __init__(self, content: str):
        spec = json.loads(content)
        model = spec["model"]
        steps = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        cutters = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        if (
            model["type"] != "BPE" or steps != ["NFC", "Replace", "Lowercase"] or spec.get("decoder")
            or [x["type"] for x in cutters] != ["Split", "ByteLevel"] or cutters[1]["add_prefix_space"]
            or model.get("dropout") or model.get("byte_fallback") or model.get("ignore_merges")
            or model.get("continuing_subword_prefix") or not model.get("end_of_word_suffix")
        ):
            raise ValueError("not a tokenizer file of this kind")
        self.suffix = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        self.names = {i: token for token, i in self.vocab.items()} | {x["id"]: x["content"] for x in spec["added_tokens"]}
        self.rank = {tuple(m.split(" ") if isinstance(m, str) else m): i for i, m in enumerate(model["merges"])}
        self.made = {a + b: (i, a, b) for (a, b), i in self.rank.items()}  # how each token is made
        self.words = regex.compile(cutters[0]["pattern"]["Regex"].replace(r"\s", SPACE))
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.splitter = regex.compile("(" + "|".join(regex.escape(x) for x in sorted(self.added, key=len, reverse=True)) + ")")
        self.bytes = byte_symbols()
        #: finds the tokens in a word by where they end, but those that merges never leave; a word's end is one symbol here
        self.ends = ahocorasick.Automaton()
        for token in filter(self._may_stand, self.vocab.keys() - {self.suffix}):
            self.ends.add_word(token.removesuffix(self.suffix) + _END if token.endswith(self.suffix) else token, token)
        self.ends.make_automaton()
        self.pairs: dict[tuple[str, str], bool] = {}
        self.known_words: dict[str, bytes] = {}
        self.store = ChunkStore()
        if any(x.isspace() or len(x.split()) != 1 for x in self.added):
            raise ValueError("an added token with white space is not cut by this encoder")
        self.plain = not any(x.isalpha() for x in self.added)  # so letters alone hold no added token
        # all tokens as bytes, a blank behind each; -1 is the size of an id without a token
        last = max(self.names)
        self.token_size, self.token_start = np.full(last + 1, -1, np.int64), np.zeros(last + 1, np.int64)
        parts = {i: self.names[i].encode() + b" " for i in sorted(self.names)}
        numbers = np.fromiter(parts, np.int64, len(parts))
        sizes = np.fromiter((len(x) for x in parts.values()), np.int64, len(parts))
        self.token_size[numbers], self.token_start[numbers] = sizes - 1, np.cumsum(sizes) - sizes
        self.token_bytes = np.frombuffer(b"".join(parts.values()), np.uint8)

    def _symbols(self, token: str) -> list[str]:
        if token.endswith(self.suffix) and token != self.suffix:
            body = token.removesuffix(self.suffix)
            return [*body[:-1], body[-1] + self.suffix]
        return list(token)

    def _merged(self, symbols: list[str]) -> list[str]:
        symbols = list(symbols)
        while len(symbols) > 1:
            ranks = [self.rank.get(pair, -1) for pair in zip(symbols, symbols[1:])]
            least = min((r for r in ranks if r >= 0), default=-1)
            if least < 0:
                break
            at = ranks.index(least)
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def _may_stand(self, token: str) -> bool:
        return self._merged(self._symbols(token)) == [token]

    def _may_follow(self, left: str, right: str) -> bool:
        found = self.pairs.get((left, right))
        if found is None:
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            found = self.pairs[(left, right)] = self._stay_apart(left, right)
        return found

    def _stay_apart(self, left: str, right: str) -> bool:
        """No merge across the border comes before the merges that make these tokens.

        Goes back in time: at each step the later of the two tokens at the border is
        taken apart again, and the pair that then stood at the border must not have
        merged before that. Of equal merges the left one comes first.
        """
        rank, made, before = self.rank, self.made, len(self.rank)
        while True:
            across = rank.get((left, right))
            if across is not None and across < before:
                return False
            at_left, at_right = made.get(left, _BASE), made.get(right, _BASE)
            if at_left[0] > at_right[0]:
                before, left = at_left[0], at_left[2]
            elif at_right[0] >= 0:
                before, right = at_right[0] + 1, at_right[1]
            else:
                return True

    def encode_words(self, words: Iterable[str]) -> dict[str, list[str]]:
        """Tokens of different words, each a string of byte symbols."""
        out: dict[str, list[str]] = {}
        lasts = [""]  # the last token of the path's prefix of each length
        before = ""
        ends, pairs, suffix = self.ends.iter, self.pairs, len(self.suffix)
        for word in sorted(words):
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del lasts[shared + 1 :]
            known, size = len(lasts), len(word)
            # all tokens by where they end, of equal ends the longest first: the first that may stand there is the last token
            for at, token in ends(word + _END):
                if at + 1 < known:
                    continue
                start = at + 1 - len(token) if at < size else size + suffix - len(token)
                if start:
                    follows = pairs.get((lasts[start], token))
                    if not (follows if follows is not None else self._may_follow(lasts[start], token)):
                        continue
                lasts.append(token)
                known += 1
            if len(lasts) != size + 2:
                raise ValueError(f"no token ends in {word!r}")
            token = lasts[size + 1]
            # the prefix that is the whole word counts for longer words only
            tokens, place = [token], size + suffix - len(token)
            del lasts[size + 1 :]
            while place:
                token = lasts[place]
                tokens.append(token)
                place -= len(token)
            tokens.reverse()
            out[word] = tokens
            before = word
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """Tokens joined by blanks, as the library does without a decoder; ids of no token are left out."""
        return " ".join([self.names[i] for i in ids if i in self.names])

    def decode_texts(self, ids: np.ndarray, edges: np.ndarray) -> pa.Array:
        """The decoded text of each range ``edges[k] : edges[k + 1]`` of ids."""
        known = (ids >= 0) & (ids < len(self.token_size))
        known[known] = self.token_size[ids[known]] >= 0
        edges = np.concatenate([[0], np.cumsum(known)])[edges]
        ids = ids[known]
        size = self.token_size[ids] + 1  # a blank behind each token but the last
        lasts = edges[1:][np.diff(edges) > 0] - 1
        size[lasts] -= 1
        out = self.token_bytes[ranges(self.token_start[ids], size)]
        offsets = np.concatenate([[0], np.cumsum(size)])[edges]
        return pa.Array.from_buffers(
            pa.large_string(), len(edges) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(out))]
        )

    def _cut(self, text: str) -> list[str]:
        """Normalised text without added tokens, cut at white space."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        if _SEPARATORS.search(text):  # str.split would cut here, the pattern does not
            return [x for x in _SPACES.split(text) if x]
        return text.split()

    def _pieces(self, text: str) -> list[str]:
        """Chunks of a text; added tokens are chunks of their own, marked by a leading blank."""
        if not any(x in text for x in self.added):
            return self._cut(text)
        out: list[str] = []
        for i, piece in enumerate(self.splitter.split(text)):
            out.extend([" " + piece] if i % 2 else self._cut(piece))
        return out

    def _encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids (int32 bytes) of texts without ASCII white space."""
        table, known, vocab = self.bytes, self.known_words, self.vocab
        cut: list[list[str]] = []
        for chunk in chunks:
            words: list[str] = []
            for piece in [chunk] if self.plain and chunk.isascii() and chunk.isalpha() and chunk.islower() else self._pieces(chunk):
                if piece[0] == " ":
                    words.append(piece)
                    known[piece] = array("i", [self.added[piece[1:]]]).tobytes()
                    continue
                found = [piece] if piece.isalpha() else self.words.findall(piece)
                words += [w if w.isascii() and w.isprintable() else "".join([table[b] for b in w.encode()]) for w in found]
            cut.append(words)
        new = {w for words in cut for w in words if w not in known}
        for word, tokens in self.encode_words(new).items():
            known[word] = array("i", [vocab[t] for t in tokens]).tobytes()
        return [known[words[0]] if len(words) == 1 else b"".join([known[w] for w in words]) for words in cut]

    def _numbers(self, chunks: list[bytes]) -> np.ndarray:
        """Numbers of the chunks in store; those that are not in it are encoded first."""
        store = self.store
        new = [chunk for chunk in chunks if chunk not in store.number]
        if len(store.number) + len(new) > CACHED_CHUNKS or store.held > CACHED_BYTES or len(self.known_words) > CACHED_CHUNKS:
            self.forget()
            store, new = self.store, chunks
        if new:
            store.add(new, self._encode_chunks([chunk.decode() for chunk in new]))
        number = store.number
        return np.fromiter((number[chunk] for chunk in chunks), np.int64, len(chunks))

    def forget(self) -> None:
        """Leaves the vocabulary and drops what was learnt from texts."""
        self.store = ChunkStore()
        self.known_words.clear()
        self.pairs.clear()

    def encode_slice(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and each text's first one (one entry more than texts).

        Texts are cut at ASCII white space, which no word, added token or composed
        character crosses. Each different chunk of the slice is looked up once.
        """
        start, end, first = word_spans(data, offsets, NONSPACE)
        if not len(start):
            return np.empty(0, np.int32), first
        kinds, which = different_spans(data, start, end)
        raw = data.tobytes()
        numbers = self._numbers([raw[a:b] for a, b in zip(start[kinds].tolist(), end[kinds].tolist())])[which]
        store = self.store
        count = store.sizes[numbers]
        ids = store.ids[ranges(store.starts[numbers], count)]
        return ids, np.concatenate([[0], np.cumsum(count)])[first]

    def encode_texts(self, texts: list[str]) -> tuple[list[bytes], list[str]]:
        """Ids (int32 bytes) and decoded text of each text."""
        parts = [text.encode() for text in texts]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in parts], dtype=np.int64)]).astype(np.int64)
        ids, edges = self.encode_slice(np.frombuffer(b"".join(parts), np.uint8), offsets)
        return [ids[a:b].tobytes() for a, b in zip(edges, edges[1:])], self.decode_texts(ids, edges).to_pylist()


class ChunkStore:
    """Ids of chunks, one behind the other in a growing array."""

    def __init__(self):
        self.number: dict[bytes, int] = {}
        self.starts, self.sizes = np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids = np.empty(0, np.int32)
        self.held = 0  # bytes, roughly

    def add(self, chunks: list[bytes], ids: list[bytes]) -> None:
        known = len(self.number)
        self.number.update(zip(chunks, range(known, known + len(chunks))))
        sizes = np.fromiter((len(x) // 4 for x in ids), np.int64, len(ids))
        ends = len(self.ids) + np.cumsum(sizes)
        self.starts, self.sizes = np.concatenate([self.starts, ends - sizes]), np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(ids), np.int32)])
        self.held += sum(len(x) for x in chunks) + 100 * len(chunks) + 4 * int(sizes.sum())


def different_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One span of each different byte string, and for every span which of these it equals."""
    _, kinds, which = np.unique(span_hash(prefix_hash(data), start, end), return_index=True, return_inverse=True)
    size, twin = end - start, kinds[which]
    if (size == size[twin]).all() and (data[ranges(start, size)] == data[ranges(start[twin], size)]).all():
        return kinds, which
    raw, number = data.tobytes(), {}  # two strings share a hash
    which = np.array([number.setdefault(raw[a:b], len(number)) for a, b in zip(start.tolist(), end.tolist())], np.int64)
    return np.unique(which, return_index=True)[1], which


_encoders: dict[str, TrieEncoder] = {}


def _encoder(content: str) -> TrieEncoder:
    key = hashlib.sha256(content.encode()).hexdigest()
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = TrieEncoder(content)
    return _encoders[key]


def _encode_batches(batches: Iterable[pa.RecordBatch], content: str) -> Iterator[pa.RecordBatch]:
    encoder = _encoder(content)
    try:
        for part in slices(batches, limit=_SLICE):
            ids, edges = encoder.encode_slice(part.data, part.offsets)
            columns = [(name, part.column(name)) for name in part.batch.schema.names if name != "text"]
            columns += [
                ("ids", pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(ids))),
                ("decoded", encoder.decode_texts(ids, edges).cast(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays([values for _, values in columns], [name for name, _ in columns])
    finally:  # the worker lives on and serves other stages
        encoder.forget()
        give_back()


def encode_documents(documents: DataFrame, tokenizer_path: str, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keys`` of every document, its token ids and the text decoded from them."""
    with open(tokenizer_path, encoding="utf-8") as file:
        content = file.read(MAX_FILE_BYTES + 1)
    if len(content) > MAX_FILE_BYTES:
        raise ValueError(f"a tokenizer file of more than {MAX_FILE_BYTES} bytes is not sent to every task")
    shared = documents.sparkSession.sparkContext.broadcast(content)
    rows = documents.select(*keys, F.col("text").cast("string").alias("text"))
    schema = "".join(f"`{k}` {kind}, " for k, kind in rows.dtypes if k != "text") + "ids array<int>, decoded string"
    return rows.mapInArrow(lambda batches: _encode_batches(batches, shared.value), schema)
