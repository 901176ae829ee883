"""Byte-pair encoding and decoding by a trie of the distinct words.

A word's encoding has a last token, and what comes before that token is the encoding of the rest.
So the last token of every prefix says it all: the last token of a prefix is the one token it ends
with that stands after the last token of the shorter prefix when the two are merged on their own.
The distinct new words of a batch are inserted into a trie; a depth-first walk carries the last
tokens of the path, so a prefix shared by many words is worked out once. A word's tokens are read
back from its end. Texts are put together from the ids of their words, of which a bounded number
is remembered.

Defined cases: null and empty texts have no tokens, and the empty text's digests; every input row
gives one output row, so null ids and repeated rows keep theirs; strings of the vocabulary's special
tokens inside a text are these tokens; a word or text of any length takes memory in proportion to
the batch that holds it; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from bayline.llm.common import prepare, worker_memo
from bayline.llm.token_counts import byte_alphabet

VOCABULARY = "word_bpe_49k.json"
# Where the symbols that end a word begin; the others are the characters of the byte alphabet.
_ENDING = 0x1000
_KNOWN_WORDS = 500_000
_KNOWN_LENGTH = 64
_KNOWN_PAIRS = 2_000_000
# Anything but white space and printable Latin-1, on which Python and the vocabulary agree.
_ODD = re.compile("[^\x09-\x0d\x20-\x7e\xa1-\xac\xae-\xff]")
# Python's split takes these for white space, the vocabulary's normaliser doesn't.
_SEPARATORS = re.compile("[\x1c-\x1f]")
# Fixed value: the vocabulary's own pattern of words, with the letters and digits of Latin-1.
_PLAIN_WORD = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]"
    r"|[^\sa-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff0-9\xb2\xb3\xb9\xbc-\xbe]+")
_SHOWN = dict(enumerate(byte_alphabet()))

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def shown(word: str) -> str:
    """The word's bytes in the byte alphabet."""
    return word if word.isascii() else word.encode("utf-8").decode("latin-1").translate(_SHOWN)


class Trie:
    """Words as paths of nested dicts; where only one word goes on, its rest is a leaf.

    From `DEEPEST` symbols on, rests of words are told apart as a whole, so long words that begin
    alike don't make paths of their own length. None marks the end of a word inside the trie.
    """

    DEEPEST = 48

    def __init__(self, words: Iterable[str]):
        self.root: dict = {}
        for word in words:
            node = self.root
            for at, symbol in enumerate(word, 1):
                if at > self.DEEPEST:
                    node[word[at - 1:]] = ""
                    break
                below = node.get(symbol)
                if below is None:
                    node[symbol] = word[at:]
                    break
                if isinstance(below, str):
                    if at == self.DEEPEST:
                        below = {below: ""} if below else {None: ""}
                    else:
                        below = {below[0]: below[1:]} if below else {None: ""}
                    node[symbol] = below
                node = below
            else:
                node[None] = ""

    def walk(self) -> Iterator[tuple[int, str, bool]]:
        """Depth first: (depth where a step begins, its symbols, does a word end with it)."""
        stack = [(0, self.root)]
        while stack:
            depth, node = stack.pop()
            if isinstance(node, tuple):
                step, node = node
                yield depth, step, None in node
                depth += len(step)
            for step, below in node.items():
                if isinstance(below, dict):
                    stack.append((depth, (step, below)))
                elif step is not None:
                    yield depth, step + below, True


class Model:
    """The vocabulary's merges, and which token may follow which."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        suffix = spec["model"]["end_of_word_suffix"]

        def symbols(token: str) -> str:
            if not token.endswith(suffix):
                return token
            token = token[:-len(suffix)]
            return token[:-1] + chr(_ENDING + ord(token[-1]))

        self.shown = {i: token for token, i in spec["model"]["vocab"].items()}
        self.symbols = {i: symbols(token) for i, token in self.shown.items()}
        self.ids = {s: i for i, s in self.symbols.items()}
        self.prefixes = {s[:n] for s in self.ids for n in range(1, len(s) + 1)}
        self.ranks: dict[tuple[str, str], int] = {}
        # How a token is made: (rank, left part, right part).
        self.made: dict[str, tuple[int, str, str]] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = map(symbols, merge.split(" ") if isinstance(merge, str) else merge)
            self.ranks.setdefault((left, right), rank)
            self.made.setdefault(left + right, (rank, left, right))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.alone: dict[int, bool] = {}
        # By token, the tokens before it that were tried.
        self.follows: dict[int, dict[int, bool]] = {}
        self.edges: dict[tuple[str, int], list[tuple[str, int]]] = {}
        self.steps: dict[str, tuple[str, tuple[tuple[int, int, dict[int, bool]], ...]]] = {}
        self.pairs = 0

    def merged(self, symbols: str) -> list[str]:
        """Plain merging of a short string, lowest rank and leftmost first."""
        parts = list(symbols)
        while len(parts) > 1:
            rank, at = min((self.ranks.get(pair, len(self.ranks)), i) for i, pair in enumerate(zip(parts, parts[1:])))
            if rank == len(self.ranks):
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def edge(self, token: str, side: int) -> list[tuple[str, int]]:
        """The parts that lie at the token's left (1) or right (2) edge while it is made, each with
        the rank of the merge that ends it."""
        found = self.edges.get((token, side))
        if found is None:
            found = [(token, len(self.ranks))]
            while found[-1][0] in self.made:
                rank, *parts = self.made[found[-1][0]]
                found.append((parts[side - 1], rank))
            self.edges[token, side] = found
        return found

    def may_follow(self, left: int, right: int) -> bool:
        """Do the symbols of both tokens merge to just these two? `left` is -1 at a word's start.

        They don't if a part at the left one's end merges with a part at the right one's beginning
        before both are used up; of merges of one rank the one further left comes first.
        """
        token = self.symbols[right]
        if left < 0 or not self.stands(right):
            return self.stands(right)
        ranks = self.ranks
        for x, x_ends in self.edge(self.symbols[left], 2):
            for y, y_ends in self.edge(token, 1):
                rank = ranks.get((x, y))
                if rank is not None and rank < x_ends and rank <= y_ends:
                    return False
        return True

    def stands(self, token: int) -> bool:
        """Do the token's own symbols merge to it?"""
        found = self.alone.get(token)
        if found is None:
            found = self.alone[token] = self.merged(self.symbols[token]) == [self.symbols[token]]
        return found

    def step(self, key: str) -> tuple[str, tuple[tuple[int, int, dict[int, bool]], ...]]:
        """From a suffix that begins some token and the symbol after it: the longest suffix that
        begins a token, and (size, id, known neighbours) of the tokens it ends with, longest first."""
        suffix = key
        while suffix not in self.prefixes:
            suffix = suffix[1:]
        tokens = ((n, self.ids.get(suffix[len(suffix) - n:])) for n in range(len(suffix), 0, -1))
        found = self.steps[key] = suffix, tuple(
            (n, i, self.follows.setdefault(i, {})) for n, i in tokens if i is not None)
        return found

    def encode_words(self, words: Iterable[str]) -> dict[str, list[int]]:
        """Ids of distinct words, given as symbols."""
        if self.pairs + len(self.steps) > _KNOWN_PAIRS:
            self.follows.clear()
            self.steps.clear()
            self.pairs = 0
        encoded = {}
        # Of the path's first d symbols: the last token, and the longest suffix that begins a token.
        last, suffixes, path = [-1], [""], ""
        steps = self.steps
        for depth, symbols, is_word in Trie(words).walk():
            del last[depth + 1:], suffixes[depth + 1:]
            path = path[:depth] + symbols
            suffix, end = suffixes[depth], depth
            for symbol in symbols:
                end += 1
                key = suffix + symbol
                suffix, tokens = steps.get(key) or self.step(key)
                for size, token, before in tokens:
                    left = last[end - size]
                    fits = before.get(left)
                    if fits is None:
                        fits = before[left] = self.may_follow(left, token)
                        self.pairs += 1
                    if fits:
                        last.append(token)
                        break
                else:
                    raise ValueError(f"no token of the vocabulary ends at {path[max(0, end - 20):end]!r}")
                suffixes.append(suffix)
            if is_word:
                tokens = []
                while end:
                    tokens.append(last[end])
                    end -= len(self.symbols[last[end]])
                tokens.reverse()
                encoded[path] = tokens
        return encoded


class TextEncoder:
    """Ids and decoded form of whole texts, as strings."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Model(path)
        # Of the library only Unicode normalising and the cutting of words, for text beyond Latin-1.
        library = Tokenizer.from_file(path)
        self.normalise = library.normalizer.normalize_str
        self.cut = library.pre_tokenizer.pre_tokenize_str
        self.special = re.compile("(" + "|".join(map(re.escape, self.model.special)) + ")")
        # Forms of a word by its symbols in the byte alphabet, those of special strings among them.
        self.ids = {mark: str(i) for mark, i in self.model.special.items()}
        self.decoded = {mark: mark for mark in self.model.special}
        self.fixed = len(self.ids)

    def symbols(self, text: str) -> list[str]:
        """The words of a text without special strings, in the byte alphabet."""
        if _ODD.search(text) is None:
            words = _PLAIN_WORD.findall(text.lower())
            return words if text.isascii() else list(map(shown, words))
        if _SEPARATORS.search(text) is None and len(chunks := text.split()) > 1:
            return [w for chunk in chunks for w in self.symbols(chunk)]
        return [w for w, _ in self.cut(self.normalise(text))]

    def words(self, text: str) -> list[str]:
        parts = self.special.split(text)
        # Every other part is a special string.
        return [w for i, part in enumerate(parts) for w in ([part] if i % 2 else self.symbols(part))]

    def learn(self, words: Iterable[str]) -> None:
        # Nothing here makes cycles, and the collector would look at each new node again and again.
        collects = gc.isenabled()
        gc.disable()
        try:
            self.put(words)
        finally:
            if collects:
                gc.enable()

    def put(self, words: Iterable[str]) -> None:
        for word, found in self.model.encode_words(
                [w[:-1] + chr(_ENDING + ord(w[-1])) for w in words]).items():
            word = word[:-1] + chr(ord(word[-1]) - _ENDING)
            self.ids[word] = " ".join(map(str, found))
            self.decoded[word] = " ".join([self.model.shown[i] for i in found])

    def __call__(self, texts: list[str | None]) -> list[tuple[int, str, str]]:
        """(number of tokens, decimal ids joined by a space, decoded text) of each text."""
        if len(self.ids) > _KNOWN_WORDS:
            for known in (self.ids, self.decoded):
                for word in list(known)[self.fixed:]:
                    del known[word]
        words = [self.words(t or "") for t in texts]
        missing = set().union(*words).difference(self.ids)
        self.learn(missing)
        out = []
        for found in words:
            ids = " ".join(map(self.ids.__getitem__, found))
            out.append((ids.count(" ") + 1 if ids else 0, ids, " ".join(map(self.decoded.__getitem__, found))))
        # Long words come once; keeping them would not be bounded.
        for word in missing:
            if len(word) > _KNOWN_LENGTH:
                del self.ids[word], self.decoded[word]
        return out


def encode_decode(docs: DataFrame, vocabulary: str | None = None, digests: bool = True) -> DataFrame:
    """One row per row of `docs`: token count and SHA-256 of its ids and of its decoded text.

    With `digests=False` the ids (array of int) and the decoded text themselves, as `ids` and
    `decoded`. `vocabulary` is the path of a BPE file with an end-of-word suffix, as executors see it.
    """
    prepare(docs.sparkSession)
    memo = worker_memo(docs.sparkSession)

    def encoded(batches):
        path = vocabulary
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(VOCABULARY)
        encode = memo.value.get(("bpe", path)) or memo.value.setdefault(("bpe", path), TextEncoder(path))
        for batch in batches:
            found = encode(batch.column("text").to_pylist())
            number = pa.array([n for n, _, _ in found], pa.int64())
            if digests:
                ids, shown = (pa.array([hashlib.sha256(t.encode()).hexdigest() for t in part], pa.string())
                              for part in ([i for _, i, _ in found], [d for _, _, d in found]))
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            else:
                ids = pa.array([list(map(int, i.split())) for _, i, _ in found], pa.list_(pa.int32()))
                shown = pa.array([d for _, _, d in found], pa.string())
                names = ["doc_id", "n_tokens", "ids", "decoded"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), number, ids, shown], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        encoded, SCHEMA if digests else "doc_id long, n_tokens long, ids array<int>, decoded string")
