"""Token counts: greedy longest-match word pieces counted by a linear automaton.

A trie over the vocabulary gets a failure link and a popped-token count per
node (after Song et al., "Fast WordPiece Tokenization", 2021). Reading a word
then takes one step per character and never builds a piece: at a mismatch the
node's longest pieces are counted and its failure link continues where greedy
longest match would.

Each document is counted where it is read; nothing is shuffled.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

ROOT, INNER = 0, 1  #: nodes where a word starts, and where it goes on
CHAR_BITS = 21  #: a code point fits; edges are keyed by node << 21 | code point
MEMO_WORDS = 200_000  #: words whose counts a task remembers at a time


def piece_vocabulary(model_file: str) -> tuple[list[str], list[str]]:
    """Pieces of a sentencepiece model that may open a word, and those that may go on with it.

    Pieces with the word-start mark open a word only; other ordinary pieces may
    stand anywhere (the model writes its bare mark before one that opens a
    word). Control, unknown and byte pieces are left out.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    start, inner = [], []
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
            continue
        piece = model.id_to_piece(i)
        text = piece.lstrip("▁")
        if not text or "▁" in text:
            continue
        (start if piece != text else inner).append(text)
    return [*dict.fromkeys([*start, *inner])], inner


def build_automaton(start: Iterable[str], inner: Iterable[str]) -> tuple[dict, list, list]:
    """``(edges, fail, popped)``; ``fail`` is -1 where greedy match fails."""
    edges: dict[int, int] = {}
    children: list[list[tuple[int, int]]] = [[], []]
    final = [False, False]
    for root, pieces in ((ROOT, start), (INNER, inner)):
        for piece in pieces:
            node = root
            for ch in piece:
                key = node << CHAR_BITS | ord(ch)
                nxt = edges.get(key)
                if nxt is None:
                    nxt = edges[key] = len(final)
                    children[node].append((ord(ch), nxt))
                    children.append([])
                    final.append(False)
                node = nxt
            final[node] = node > INNER
    fail, popped = [-1] * len(final), [0] * len(final)
    queue = deque((ROOT, INNER))
    while queue:  # by depth: a failure link leads to a node nearer its root
        node = queue.popleft()
        for code, child in children[node]:
            queue.append(child)
            if final[child]:
                fail[child], popped[child] = INNER, 1
                continue
            at, count = fail[node], popped[node]
            while at >= 0 and (at << CHAR_BITS | code) not in edges:
                count += popped[at]
                at = fail[at]
            if at >= 0:
                fail[child], popped[child] = edges[at << CHAR_BITS | code], count
    return edges, fail, popped


def word_pieces(word: str, automaton: tuple[dict, list, list]) -> int:
    """Pieces of greedy longest match, or -1 if it fails (an unknown word)."""
    edges, fail, popped = automaton
    node = ROOT
    count = 0
    for ch in word:
        code = ord(ch)
        nxt = edges.get(node << CHAR_BITS | code)
        while nxt is None:
            count += popped[node]
            node = fail[node]
            if node < 0:
                return -1
            nxt = edges.get(node << CHAR_BITS | code)
        node = nxt
    while node != INNER:
        count += popped[node]
        node = fail[node]
        if node < 0:
            return -1
    return count


def _counts(text: str | None, automaton, memo: dict[bytes, int]) -> tuple[int, int, int]:
    words = (text or "").encode().split()  # bytes split at ASCII white space only
    tokens = unknown = 0
    for w in words:
        n = memo.get(w)
        if n is None:
            if len(memo) >= MEMO_WORDS:
                memo.clear()
            n = memo[w] = word_pieces(w.decode(), automaton)
        if n < 0:
            unknown += 1
            tokens += 1
        else:
            tokens += n
    return len(words), tokens, unknown


def token_counts(docs: DataFrame, vocabulary: tuple[Iterable[str], Iterable[str]],
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id, n_words, n_tokens, n_unknown``.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text, of any length; an
    unknown word is one token. A null or empty text has zero words. Repeated
    rows and null ids give one row each; other columns are ignored; an empty
    table gives no rows. ``vocabulary``: word-start and word-inner pieces; it
    is broadcast (its size is the vocabulary file's).
    """
    shared = docs.sparkSession.sparkContext.broadcast(build_automaton(*vocabulary))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, memo = shared.value, {}
        for batch in batches:
            rows = [_counts(t.as_py(), automaton, memo) for t in batch.column(1)]
            cols = list(zip(*rows)) if rows else [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in cols)],
                ["doc_id", "n_words", "n_tokens", "n_unknown"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        count, f"doc_id {kind}, n_words long, n_tokens long, n_unknown long")
