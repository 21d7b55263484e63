"""Token counts by compiled finite-state transducers.

A byte-level BPE vocabulary is compiled into two deterministic transducers.

*Pieces.*  The pattern that cuts a text before the merges becomes an automaton of eight states over
classes of characters (a character's class also says what the pattern looks ahead to).  Texts are run
as one stream: each chunk of characters gives a map from every state to the state after the chunk, the
maps are composed by a parallel prefix scan, and each chunk is then replayed from its known start.

*Tokens.*  Merges become a transducer over bytes whose transitions are annotated with the number of
tokens they emit.  The encoding of a string's prefix ends in one token, and a token may follow another
exactly if the two, merged together, stay as they are; so a state holds, for each place where a token
could still begin, the token that ends there and the difference in tokens.  The subset construction
is lazy: transitions are worked out when a text first needs them and kept in the worker.  A count is
the sum of the annotations; they add over any cut, and a transition may take tokens back.

Defined cases: null and empty texts have no tokens; a special string in the text counts as one token
and cuts the text, as the library does by default; rows are counted one by one, so repeated rows and
null ids are no matter; only doc_id and text are read.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adherence.llm.base import table
from adherence.llm.words import slices

CHUNK = 64
#: Pieces whose counts a worker keeps; the store is emptied when it is full.
KEPT_PIECES = 300_000
#: Transitions that a worker keeps.
KEPT_TRANSITIONS = 500_000

LETTER, NUMBER, SPACE, WHITE, OTHER, QUOTE = range(6)
# symbols of the automaton: a class, with what follows where that matters
(S_LETTER, S_NUMBER, S_OTHER, S_QUOTE, S_QUOTE2, S_QUOTE3, S_SPACE_LAST, S_WHITE_LAST, S_WHITE_MORE) = range(9)
N_SYMBOLS = 9  # a symbol plus this: the same at the start of a text
# states: the piece that is open after a character
CLOSED, IN_LETTERS, IN_NUMBERS, IN_OTHER, AFTER_SPACE, IN_WHITE, ONE_LEFT, TWO_LEFT = range(8)


def piece_transducer() -> tuple[np.ndarray, np.ndarray]:
    """(next state, 1 if a piece begins) by state and symbol, for the pattern
    ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``."""
    go, begins = np.zeros((8, N_SYMBOLS), np.uint8), np.ones((8, N_SYMBOLS), np.uint8)
    for symbol, state in ((S_LETTER, IN_LETTERS), (S_NUMBER, IN_NUMBERS), (S_OTHER, IN_OTHER), (S_QUOTE, IN_OTHER)):
        go[:, symbol] = state
        begins[AFTER_SPACE, symbol] = begins[state, symbol] = 0
    go[ONE_LEFT, S_LETTER], begins[ONE_LEFT, S_LETTER] = CLOSED, 0
    go[TWO_LEFT, S_LETTER], begins[TWO_LEFT, S_LETTER] = ONE_LEFT, 0
    for symbol, state in ((S_QUOTE2, ONE_LEFT), (S_QUOTE3, TWO_LEFT)):
        go[:, symbol] = state
        for joined in (IN_OTHER, AFTER_SPACE):  # the quote belongs to a run that is already open
            go[joined, symbol], begins[joined, symbol] = IN_OTHER, 0
    go[:, S_WHITE_MORE] = IN_WHITE
    begins[IN_WHITE, S_WHITE_MORE] = 0
    go[:, S_WHITE_LAST] = CLOSED
    go[:, S_SPACE_LAST] = AFTER_SPACE
    fresh = np.broadcast_to(go[CLOSED], go.shape)
    return np.hstack([go, fresh]), np.hstack([begins, np.ones_like(begins)])


def character_classes() -> np.ndarray:
    """The class of every code point."""
    kinds = np.full(0x110000, OTHER, np.uint8)
    for cp in range(0x110000):
        k = unicodedata.category(chr(cp))[0]
        if k == "L":
            kinds[cp] = LETTER
        elif k == "N":
            kinds[cp] = NUMBER
    kinds[[0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, *range(9, 14)]] = WHITE
    kinds[0x20], kinds[0x27], kinds[0] = SPACE, QUOTE, OTHER
    return kinds


class PieceScanner:
    def __init__(self):
        self.kinds = character_classes()
        self.go, self.begins = piece_transducer()

    def symbols(self, chars: np.ndarray, breaks: np.ndarray) -> np.ndarray:
        """Symbols of the characters; ``breaks`` are the places where a new text begins."""
        kinds = self.kinds[chars]
        white = (kinds == SPACE) | (kinds == WHITE)
        cut = np.zeros(len(chars) + 3, bool)
        cut[breaks] = True
        cut[len(chars):] = True
        after = np.ones(len(chars), bool)  # white space or the end follows
        after[:-1] = white[1:]
        after |= cut[1:len(chars) + 1]
        out = np.full(len(chars), S_OTHER, np.uint8)
        out[kinds == LETTER] = S_LETTER
        out[kinds == NUMBER] = S_NUMBER
        out[white & after] = S_WHITE_MORE
        out[white & ~after] = S_WHITE_LAST
        out[(kinds == SPACE) & ~after] = S_SPACE_LAST
        quotes = np.flatnonzero(kinds == QUOTE)
        if len(quotes):
            padded = np.concatenate([chars, np.zeros(2, chars.dtype)])
            one, two = padded[quotes + 1], padded[quotes + 2]
            has1, has2 = ~cut[quotes + 1], ~cut[quotes + 1] & ~cut[quotes + 2]
            pair = np.zeros(len(quotes), bool)
            for a, b in ("re", "ve", "ll"):
                pair |= (one == ord(a)) & (two == ord(b))
            out[quotes] = np.where(has1 & np.isin(one, [ord(c) for c in "stmd"]), S_QUOTE2, np.where(has2 & pair, S_QUOTE3, S_QUOTE))
        out[breaks[breaks < len(chars)]] += N_SYMBOLS
        return out

    def piece_starts(self, chars: np.ndarray, breaks: np.ndarray) -> np.ndarray:
        """Character positions where pieces begin."""
        n = len(chars)
        if not n:
            return np.zeros(0, np.int64)
        symbols = self.symbols(chars, breaks)
        n_chunks = -(-n // CHUNK)
        padded = np.zeros(n_chunks * CHUNK, np.uint8)  # the last chunk is filled up; its tail is cut off again
        padded[:n] = symbols
        grid = np.ascontiguousarray(padded.reshape(n_chunks, CHUNK).T)
        flat = self.go.reshape(-1)
        # the map of each chunk, for all start states at once
        maps = np.broadcast_to(np.arange(8, dtype=np.uint8), (n_chunks, 8)).copy()
        for row in grid:
            maps = flat[maps * np.uint8(2 * N_SYMBOLS) + row[:, None]]
        # prefix scan: maps[i] becomes the composition of chunks 0..i
        step = 1
        while step < n_chunks:
            later = np.take_along_axis(maps[step:], maps[:-step], axis=1)
            maps = np.concatenate([maps[:step], later])
            step *= 2
        state = np.concatenate([[CLOSED], maps[:-1, CLOSED]]).astype(np.uint8)
        begins, out = self.begins.reshape(-1), np.empty((CHUNK, n_chunks), bool)
        for i, row in enumerate(grid):
            at = state * np.uint8(2 * N_SYMBOLS) + row
            out[i] = begins[at]
            state = flat[at]
        return np.flatnonzero(out.T.reshape(-1)[:n])


class TokenTransducer:
    """Emitted-token counts of pieces."""

    def __init__(self, vocabulary: dict[str, int], merges: list):
        # bytes are written as printable characters in the vocabulary: those that print stand for
        # themselves, the others take the code points from 256 on
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(printable))}
        raw = lambda s: bytes(of[c] for c in s)
        self.token = {raw(t): i for t, i in vocabulary.items() if all(c in of for c in t)}
        self.text = {i: t for t, i in self.token.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.rank = {(vocabulary[a], vocabulary[b]): (i, vocabulary[a + b]) for i, (a, b) in enumerate(pairs)}
        self.trie: list[dict[int, int]] = [{}]
        self.at_node: list[int] = [-1]
        for t, i in self.token.items():
            node = 0
            for b in t:
                if b not in self.trie[node]:
                    self.trie[node][b] = len(self.trie)
                    self.trie.append({})
                    self.at_node.append(-1)
                node = self.trie[node][b]
            self.at_node[node] = i
        self.follows: dict[tuple[int, int], bool] = {}
        self._empty()
        self.count_of: dict[bytes, int] = {}

    def _empty(self) -> None:
        self.states: dict[tuple, int] = {((0, -1, 0),): 0}
        self.members: list[tuple] = [((0, -1, 0),)]
        self.next: list[dict[int, tuple[int, int]]] = [{}]
        self.n_transitions = 0

    def merge(self, ids: list[int]) -> list[int]:
        """The merges applied to a short sequence, lowest rank first; used while compiling."""
        while len(ids) > 1:
            best = min(((self.rank.get((a, b), (1 << 60, 0))), k) for k, (a, b) in enumerate(zip(ids, ids[1:], strict=False)))
            if best[0][0] == 1 << 60:
                break
            rank, new = best[0]
            out, k = [], 0
            while k < len(ids):
                if k + 1 < len(ids) and self.rank.get((ids[k], ids[k + 1]), (-1,))[0] == rank:
                    out.append(new)
                    k += 2
                else:
                    out.append(ids[k])
                    k += 1
            ids = out
        return ids

    def may_follow(self, a: int, b: int) -> bool:
        """Whether token b can stand after token a (a = -1: at the start) in an encoding."""
        if (a, b) not in self.follows:
            if len(self.follows) >= KEPT_TRANSITIONS:
                self.follows = {}
            text = (self.text[a] if a >= 0 else b"") + self.text[b]
            self.follows[a, b] = self.merge([self.token[bytes([x])] for x in text]) == ([a, b] if a >= 0 else [b])
        return self.follows[a, b]

    def step(self, state: int, byte: int) -> tuple[int, int]:
        """(next state, tokens emitted), worked out and kept."""
        alive, last = [], None
        for node, token, more in self.members[state]:
            child = self.trie[node].get(byte)
            if child is None:
                continue
            if self.trie[child]:
                alive.append((child, token, more))
            t = self.at_node[child]
            if t >= 0 and last is None and self.may_follow(token, t):
                last = (t, more + 1)
        t, emitted = last
        key = (*((node, token, more - emitted) for node, token, more in alive), (0, t, 0))
        if key not in self.states:
            self.states[key] = len(self.members)
            self.members.append(key)
            self.next.append({})
        self.next[state][byte] = out = (self.states[key], emitted)
        self.n_transitions += 1
        return out

    def count(self, piece: bytes) -> int:
        if self.n_transitions > KEPT_TRANSITIONS:
            self._empty()
        state, total, table_ = 0, 0, self.next
        for byte in piece:
            hit = table_[state].get(byte)
            state, emitted = hit if hit is not None else self.step(state, byte)
            total += emitted
        return total

    def counts(self, pieces: list[bytes]) -> np.ndarray:
        known, count = self.count_of, self.count
        out = np.empty(len(pieces), np.int64)
        for i, p in enumerate(pieces):
            n = known.get(p)
            if n is None:
                n = count(p)
                if len(p) <= 32:
                    if len(known) >= KEPT_PIECES:
                        known.clear()
                    known[p] = n
            out[i] = n
        return out


class Tokenizer:
    """Counts tokens of Arrow string columns."""

    def __init__(self, content: str):
        j = json.loads(content)
        self.specials = [t["content"] for t in j["added_tokens"]]
        self.scanner = PieceScanner()
        self.tokens = TokenTransducer(j["model"]["vocab"], j["model"]["merges"])

    def count_rows(self, col: pa.Array) -> np.ndarray:
        texts = pc.fill_null(col.cast(pa.large_string()), "")
        special = np.zeros(len(texts), np.int64)
        owner = np.arange(len(texts))
        for s in self.specials:
            if pc.any(pc.match_substring(texts, s)).as_py():
                parts = pc.split_pattern(texts, s)
                sizes = pc.list_value_length(parts).to_numpy(zero_copy_only=False)
                np.add.at(special, owner, sizes - 1)
                texts, owner = parts.flatten(), np.repeat(owner, sizes)
        chars, lengths = self._chars(texts)
        begins = np.concatenate([[0], np.cumsum(lengths)])
        starts = self.scanner.piece_starts(chars, np.unique(begins[:-1][lengths > 0]))
        # byte offsets of the pieces
        width = 1 + (chars > 0x7F).astype(np.int64) + (chars > 0x7FF) + (chars > 0xFFFF)
        at = np.concatenate([[0], np.cumsum(width)])
        offsets = np.append(at[starts], at[-1])
        if not len(starts):
            return special
        _, begin, data = texts.buffers()
        first = int(np.frombuffer(begin, np.int64)[texts.offset])
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets + first), data])
        coded = pieces.dictionary_encode()
        per = self.tokens.counts(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        total = np.concatenate([[0], np.cumsum(per)])
        bounds = np.searchsorted(starts, begins)
        np.add.at(special, owner, total[bounds[1:]] - total[bounds[:-1]])
        return special

    @staticmethod
    def _chars(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """Code points of all texts in a row, and how many each text has."""
        off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        data = texts.buffers()[2] if len(texts) else None
        raw = bytes(memoryview(data)[off[0]:off[-1]]) if data is not None else b""
        chars = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        lengths = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        return chars, lengths


_workers: dict[str, Tokenizer] = {}


def token_counts(docs: DataFrame, vocabulary_path: str, limit: int = 512) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every document.  The vocabulary file is read on the
    driver and sent to the workers (it is a fixed size of about a MB)."""
    with open(vocabulary_path, encoding="utf-8") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())

    def count(batches):
        if vocabulary_path not in _workers:
            _workers[vocabulary_path] = Tokenizer(content.value)
        t = _workers[vocabulary_path]
        for batch in batches:
            text = batch.column("text")
            for a, b in slices(text):
                col = text.slice(a, b - a)
                n = t.count_rows(col)
                size = pc.fill_null(pc.binary_length(col), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), size, pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select("doc_id", "text").mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
