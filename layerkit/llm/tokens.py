"""Token ids and counts of white-space words, remembered per worker.

The word tokenizer drops white space and never lets a pre-token cross it, and
its normalizers (NFC, white-space folding, lower-casing char by char) do not
look across white space either. The ids of a text are therefore the ids of
its words, one after the other. Words are lower-cased before (A-Z; the
tokenizer does it anyway), and signs after a letter or digit at a word's end
are pre-tokens of their own. So each worker asks the tokenizers library once
per distinct bare word and remembers the answer, in two generations of up to
``REMEMBER`` words: when the younger is full it becomes the older, and words
still in use move on. Texts that hold "<|" may name special tokens and are
looked up as they are.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Fixed value: the tokenizer file of the contracts.
WORD_BPE = "word_bpe_49k.json"
_SIGNS = b",.;:!?#$%&*"
REMEMBER = 700_000
# Words asked for in one text.
JOIN = 1000
# Bytes of the texts that are looked up together.
CHUNK = 1 << 24


def _ends_in_letter(word: bytes) -> bool:
    """Whether a word surely ends in a letter or digit, lower-cased too (some
    capitals become a letter and a mark): of the blocks that every Unicode
    version has alike."""
    if word[-1] < 0x80:
        return word[-1:].isalnum()
    last = word[-4:].decode("utf-8", "ignore")[-1:]
    return last < "\u0250" and last.lower().isalpha()


class _Memory(dict):
    """Ids of lower-cased words as little-endian uint16; asks for a word that
    is not there."""

    def __init__(self, library):
        super().__init__()
        self.library, self.older = library, {}
        # ids that end a pre-token
        vocabulary = library.get_vocab(with_added_tokens=True)
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

    def learn(self, words: set[bytes]) -> None:
        """Remember the ids of ``words``, asking for many at a time. A word of
        letters is one pre-token, so the ids of many such words in one text
        part where a pre-token ends."""
        if len(self) > REMEMBER:
            self.older = dict(self)
            self.clear()
        older = self.older
        bare = {w.rstrip(_SIGNS) for w in words}
        bare = [w for w in bare if w and w not in self and w not in older]
        texts = [w.decode("utf-8", "replace") for w in bare]
        new = [(w, t) for w, t in zip(bare, texts) if t.isalpha()]
        joined = [" ".join([t for _, t in new[i : i + JOIN]]) for i in range(0, len(new), JOIN)]
        for i, e in enumerate(self.library.encode_batch_fast(joined, add_special_tokens=False)):
            part, ids = new[i * JOIN : (i + 1) * JOIN], np.array(e.ids, "<u2")
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(part):
                raw, cuts = ids.tobytes(), [0, *(2 * ends).tolist()]
                self.update((w, raw[a:b]) for (w, _), a, b in zip(part, cuts, cuts[1:]))
        # other words one by one, but asked for together
        rest = [(w, t) for w, t in zip(bare, texts) if not t.isalpha()]
        for i in range(0, len(rest), JOIN):
            part = rest[i : i + JOIN]
            for (w, _), e in zip(part, self.library.encode_batch_fast([t for _, t in part], add_special_tokens=False)):
                self[w] = np.array(e.ids, "<u2").tobytes()

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            bare = word.rstrip(_SIGNS)
            if bare and bare != word and b"<|" not in word and _ends_in_letter(bare):
                ids = self[bare] + self[word[len(bare) :]]
            else:
                found = self.library.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids
                ids = np.array(found, "<u2").tobytes()
        self[word] = ids
        return ids


class WordEncoder:
    """Ids of texts as little-endian uint16 (vocabularies up to 65,536)."""

    def __init__(self, tokenizer: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        path = tokenizer
        if not os.path.isabs(tokenizer):
            import public_tokenizers

            path = public_tokenizers.path(tokenizer)
        library = Tokenizer.from_file(str(path))
        self.vocabulary = library.get_vocab_size(with_added_tokens=True)
        if self.vocabulary > 1 << 16:
            raise ValueError("ids do not fit 16 bits")
        self._memory = _Memory(library)

    @staticmethod
    def _words(text: str | None) -> list[bytes]:
        raw = (text or "").encode("utf-8", "replace")
        return (raw if b"<|" in raw else raw.lower()).split()

    def learn(self, texts: Iterable[str | None]) -> None:
        """Prepare for ``texts``: their new words are asked for together."""
        words: set[bytes] = set()
        for t in texts:
            words.update(self._words(t))
            if len(words) > REMEMBER:
                self._memory.learn(words)
                words = set()
        self._memory.learn(words)

    def batch(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of ``texts``, one after the other. The words of some texts
        are cut together, and each distinct one is looked up once."""
        held, size = [], 0
        for t in texts:
            held.append((t or "").encode("utf-8", "replace"))
            size += len(held[-1])
            if size >= CHUNK:
                yield from self._chunk(held)
                held, size = [], 0
        if held:
            yield from self._chunk(held)

    def _chunk(self, raws: list[bytes]) -> Iterator[bytes]:
        memory = self._memory
        cased = [raw if b"<|" in raw else raw.lower() for raw in raws]
        # beside words there are empty ones, at a text's edges: they have no ids
        words = pc.ascii_split_whitespace(pa.array(cased, pa.binary()).cast(pa.large_string()))
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.cast(pa.large_binary()).to_pylist()
        found = list(map(memory.get, distinct))
        gaps = [i for i, ids in enumerate(found) if ids is None]
        memory.learn({distinct[i] for i in gaps})
        for i in gaps:
            found[i] = memory[distinct[i]]
        ids = pa.array(found, pa.large_binary()).take(coded.indices)
        _, starts, values = ids.buffers()
        cuts = np.frombuffer(starts, np.int64)[words.offsets.to_numpy()].tolist()
        raw = memoryview(values) if values is not None else b""
        for a, b in zip(cuts, cuts[1:]):
            yield bytes(raw[a:b])

    def ids(self, text: str | None) -> bytes:
        return b"".join(map(self._memory.__getitem__, self._words(text)))

    def count(self, text: str | None) -> int:
        return len(self.ids(text)) // 2


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(tokenizer: str = WORD_BPE) -> WordEncoder:
    """The worker's encoder for a tokenizer: a file path, or the name of one
    of the public tokenizers."""
    if tokenizer not in _ENCODERS:
        _ENCODERS[tokenizer] = WordEncoder(tokenizer)
    return _ENCODERS[tokenizer]
