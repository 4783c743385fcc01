"""Token counts that follow edits.

Each document keeps a segment tree over its pre-tokens: a leaf holds a run of
them (about ``LEAF`` characters, ending with white space), an inner node the
characters and tokens of its two children. An edit walks down by character
sums, takes the words it touches plus the boundary context (out to the next
white space on both sides, across leaves where an edit joins words),
re-encodes only those, and adds the difference up the path.

The tokenizer never lets a token cross white space (see ``tokens``), so the
count always equals that of encoding the edited text afresh.

An edit is ``(start, end, text)`` in code points of the text as edited so
far: [start, end) is replaced by ``text``. Positions are clipped to the text;
``end`` before ``start`` inserts at ``start``; a NULL edit, position or text
counts as no edit, zero and empty.

Defined cases: a NULL text counts as empty; an empty text has no tokens and
can be edited; repeated rows are counted each; an empty table gives no rows;
other columns pass through.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerkit.llm.common import SPACES, col, free_name
from layerkit.llm.tokens import WORD_BPE, WordEncoder, encoder

LEAF = 512
# A leaf that has grown to this many times its size is cut anew.
GROWN = 16
_WHITE = frozenset(SPACES)


def cut(text: str, size: int = LEAF) -> list[str]:
    """Leaves of about ``size`` characters, each ending with white space but
    the last; a longer word stays whole."""
    out, at, n = [], 0, len(text)
    while at < n:
        end = min(n, at + size)
        while end < n and text[end - 1] not in _WHITE:
            end += 1
        out.append(text[at:end])
        at = end
    return out or [""]


class TokenTree:
    """A segment tree of (characters, tokens) over the leaves of a text."""

    def __init__(self, text: str, enc: WordEncoder, counts: list[int] | None = None):
        self.enc, self.encoded = enc, 0
        self._grow(cut(text), counts)

    def _grow(self, leaves: list[str], counts: list[int] | None = None) -> None:
        self.leaves = leaves
        n = 1
        while n < len(leaves):
            n *= 2
        self.n = n
        self.chars, self.tokens = [0] * (2 * n), [0] * (2 * n)
        for i, t in enumerate(leaves):
            self.chars[n + i] = len(t)
            self.tokens[n + i] = counts[i] if counts else self._count(t)
        for i in range(n - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def _count(self, text: str) -> int:
        self.encoded += len(text)
        return self.enc.count(text)

    @property
    def count(self) -> int:
        return self.tokens[1]

    @property
    def text(self) -> str:
        return "".join(self.leaves)

    def find(self, pos: int) -> tuple[int, int]:
        """Leaf and place in it of a position (the text's end: in the last leaf)."""
        i = 1
        while i < self.n:
            left = self.chars[2 * i]
            if pos < left or not self.chars[2 * i + 1]:
                i = 2 * i
            else:
                pos -= left
                i = 2 * i + 1
        return i - self.n, pos

    def _set(self, leaf: int, text: str, tokens: int) -> None:
        self.leaves[leaf] = text
        i = self.n + leaf
        self.chars[i], self.tokens[i] = len(text), tokens
        i //= 2
        while i:
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]
            i //= 2

    def edit(self, start: int, end: int, new: str) -> None:
        total = self.chars[1]
        start = min(max(start, 0), total)
        end = min(max(end, start), total)
        a, i = self.find(start)
        b, j = self.find(end)
        # boundary context: back and on to white space, over leaves
        while True:
            t = self.leaves[a]
            while i and t[i - 1] not in _WHITE:
                i -= 1
            if i or a == 0:
                break
            a -= 1
            i = len(self.leaves[a])
        while True:
            t = self.leaves[b]
            while j < len(t) and t[j] not in _WHITE:
                j += 1
            if j < len(t) or b == len(self.leaves) - 1:
                break
            b += 1
            j = 0
        head, tail = self.leaves[a][:i], self.leaves[b][j:]
        held = self.leaves[a][i:j] if a == b else "".join([self.leaves[a][i:], *self.leaves[a + 1 : b], self.leaves[b][:j]])
        first = start - self._before(a) - i
        region = held[:first] + new + held[first + end - start :]
        tokens = sum(self.tokens[self.n + a : self.n + b + 1]) + self._count(region) - self._count(held)
        for leaf in range(a + 1, b + 1):
            if self.leaves[leaf]:
                self._set(leaf, "", 0)
        self._set(a, head + region + tail, tokens)
        if len(self.leaves[a]) > GROWN * LEAF:
            parts = cut(self.leaves[a])
            if len(parts) > 1:
                self._regrow(a, parts)

    def _before(self, leaf: int) -> int:
        """Characters before a leaf."""
        i, n = self.n + leaf, 0
        while i > 1:
            if i & 1:
                n += self.chars[i - 1]
            i //= 2
        return n

    def _regrow(self, a: int, parts: list[str]) -> None:
        counts = self.tokens[self.n : self.n + len(self.leaves)]
        own = [self._count(p) for p in parts]
        leaves = self.leaves[:a] + parts + self.leaves[a + 1 :]
        counts = counts[:a] + own + counts[a + 1 :]
        kept = [(t, c) for t, c in zip(leaves, counts) if t] or [("", 0)]
        self._grow([t for t, _ in kept], [c for _, c in kept])


_STATE = "struct<chars: array<int>, tokens: array<int>>"
_DONE = "struct<text: string, tree: struct<chars: array<int>, tokens: array<int>>, n_before: long, n_after: long, encoded_chars: long>"


def grow(text: Column, tokenizer: str = WORD_BPE) -> Column:
    """The tree of a text: characters and tokens of its leaves. Together with
    the text it is all that later edits need."""

    @F.pandas_udf(_STATE)
    def run(s: pd.Series) -> pd.DataFrame:
        enc, rows = encoder(tokenizer), []
        enc.learn(s)
        for t in s:
            leaves = cut(t or "")
            rows.append(([len(x) for x in leaves], [enc.count(x) for x in leaves]))
        return pd.DataFrame(rows, columns=["chars", "tokens"])

    return run(text)


def _from_state(text: str, chars, tokens, enc: WordEncoder) -> TokenTree:
    tree = TokenTree.__new__(TokenTree)
    tree.enc, tree.encoded = enc, 0
    leaves, at = [], 0
    for c in chars:
        leaves.append(text[at : at + c])
        at += c
    tree._grow(leaves, [int(x) for x in tokens])
    return tree


def _apply(tree: TokenTree, todo) -> tuple:
    before = tree.count
    for e in todo if todo is not None else ():
        if e is not None:
            tree.edit(int(e["start"] or 0), int(e["end"] or 0), e["text"] or "")
    state = {"chars": [len(x) for x in tree.leaves], "tokens": tree.tokens[tree.n : tree.n + len(tree.leaves)]}
    return tree.text, state, before, tree.count, tree.encoded


_FIELDS = ["text", "tree", "n_before", "n_after", "encoded_chars"]


def edited(text: Column, tree: Column, edits: Column, tokenizer: str = WORD_BPE) -> Column:
    """Apply ``edits`` (an array of ``(start, end, text)``) in order: the new
    text, its tree, the counts before and after, and the characters encoded."""

    @F.pandas_udf(_DONE)
    def run(texts: pd.Series, trees: pd.DataFrame, lists: pd.Series) -> pd.DataFrame:
        enc = encoder(tokenizer)
        rows = [
            _apply(_from_state(t or "", chars, tokens, enc), todo)
            for t, chars, tokens, todo in zip(texts, trees["chars"], trees["tokens"], lists)
        ]
        return pd.DataFrame(rows, columns=_FIELDS)

    return run(text, tree, edits)


def grown_and_edited(text: Column, edits: Column, tokenizer: str = WORD_BPE) -> Column:
    """``edited`` for texts that have no tree yet: it is grown in the same
    pass, and ``encoded_chars`` counts the edits' share alone."""

    @F.pandas_udf(_DONE)
    def run(texts: pd.Series, lists: pd.Series) -> pd.DataFrame:
        enc, rows = encoder(tokenizer), []
        enc.learn(texts)
        for t, todo in zip(texts, lists):
            tree = TokenTree(t or "", enc)
            tree.encoded = 0
            rows.append(_apply(tree, todo))
        return pd.DataFrame(rows, columns=_FIELDS)

    return run(text, edits)


def with_edits(docs: DataFrame, edits: DataFrame, key: str = "doc_id", into: str = "edits") -> DataFrame:
    """``docs`` with their edits ``(key, seq, start, end, text)`` as one array
    in order of ``seq``; NULL for a document without any."""
    own = free_name([*docs.columns, into], "edit_key")
    todo = edits.groupBy(col(key).alias(own)).agg(F.sort_array(F.collect_list(F.struct("seq", "start", "end", "text"))).alias(into))
    return docs.join(todo, col(key).eqNullSafe(col(own)), "left").drop(own)
