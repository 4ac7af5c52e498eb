"""Encoding and decoding with the merges of a byte-pair vocabulary, by segment trees over pair ranks.

A word is a row of symbols. Over its adjacent pairs lies a segment tree whose leaves are the ranks of
the pairs and whose inner nodes hold the smaller rank of their children: the root names the lowest
rank, and going down left first finds its leftmost place. A merge changes that pair and its two
neighbours, so three leaves and the paths above them are updated, in logarithmic time. It ends when
the root says that no pair can be merged. The trees of many words are rows of the same arrays, so one
step merges one pair in each of them.

Text is brought into words as the vocabulary file says: special tokens are cut out, the rest is
normalised (NFC, white space to one space, lower case) and split by the file's pattern, and bytes
become printable characters. Other kinds of files are refused.
"""

import hashlib
import json
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Regex, normalizers, pre_tokenizers

_OLD_SCRIPTS = "\u0500"
NO_PAIR = np.int32(2**31 - 1)
CACHED_PIECES = 100_000  # encoded pieces kept per generation and task
_CONTROLS = regex.compile("[\x1c-\x1f]")
_SYMBOLS_AT_ONCE = 1 << 16
_FEW, _LONG = 8, 64  # fewer words than that, of so many symbols, are merged one by one


def byte_characters() -> list[str]:
    """The printable character that stands for each byte."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(moved)) for b in range(256)]


class Vocabulary:
    """Symbols, merges and text rules of a vocabulary file."""

    def __init__(self, file: str):
        model = json.loads(file)
        bpe = model["model"]
        plain = ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")
        if bpe["type"] != "BPE" or any(bpe.get(option) for option in plain) or model["decoder"]:
            raise ValueError("this kind of vocabulary file is not supported")
        self.ids: dict[str, int] = bpe["vocab"]
        self.ends = bpe["end_of_word_suffix"] or ""
        self.tokens = {i: t for t, i in self.ids.items()}
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in model["added_tokens"]):
            raise ValueError("special tokens that strip or are normalised are not supported")
        self.tokens |= {i: t for t, i in self.special.items()}
        names = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.normalise = normalizers.Sequence([self._normaliser(n) for n in model["normalizer"]["normalizers"]])
        split, byte_level = model["pre_tokenizer"]["pretokenizers"]
        if split["behavior"] != "Removed" or not split["invert"] or byte_level["use_regex"] or byte_level["add_prefix_space"]:
            raise ValueError("this way to split text is not supported")
        # white space by its Unicode property, without the control characters that Python adds
        pattern = split["pattern"]["Regex"]
        self._findall = regex.compile(pattern.replace("\\s", "\\p{White_Space}")).findall
        self._library_split = pre_tokenizers.Split(Regex(pattern), "removed", invert=True).pre_tokenize_str
        self.first = np.array([self.ids[c] for c in byte_characters()], np.int32)
        self.last = np.array([self.ids[c + self.ends] for c in byte_characters()], np.int32)
        pairs = np.empty((len(bpe["merges"]), 2), np.int64)
        merged = np.empty(len(bpe["merges"]), np.int32)
        for rank, merge in enumerate(bpe["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pairs[rank] = self.ids[left], self.ids[right]
            merged[rank] = self.ids[left + right]
        keys = pairs[:, 0] << 32 | pairs[:, 1]
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.merged = np.append(merged, 0)
        self.numbers = list(range(1 + max(self.tokens)))
        self.rank_of = dict(zip(keys[::-1].tolist(), range(len(keys) - 1, -1, -1)))  # the first rank of a repeated pair
        self.merged_list = merged.tolist()

    @staticmethod
    def _normaliser(rule: dict):
        match rule["type"]:
            case "NFC":
                return normalizers.NFC()
            case "Lowercase":
                return normalizers.Lowercase()
            case "Replace":
                return normalizers.Replace(Regex(rule["pattern"]["Regex"]), rule["content"])
        raise ValueError(f"normaliser {rule['type']} is not supported")

    def words(self, text: str) -> list[str]:
        """The words of normalised text. What is a letter beyond old scripts depends on the library's Unicode version."""
        if text.isascii() or max(text) < _OLD_SCRIPTS:
            return self._findall(text)
        return [word for word, _ in self._library_split(text)]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, ``NO_PAIR`` where none merges; -1 is no symbol."""
        keys = left.astype(np.int64) << 32 | np.maximum(right, 0).astype(np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        found = (self.keys[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(found, self.order[at], NO_PAIR).astype(np.int32)

    def encode_words(self, words: Sequence[str]) -> list[tuple[int, ...]]:
        """Ids of each word. Words of like length go into one array of trees."""
        if not words:
            return []
        raw = [w.encode() for w in words]
        data = np.frombuffer(b"".join(raw), np.uint8)
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        ends = np.cumsum(lengths)
        symbols = self.first[data]
        symbols[ends - 1] = self.last[data[ends - 1]]  # the last symbol of a word also says that it ends
        widths = np.maximum(2, 1 << np.ceil(np.log2(lengths)).astype(np.int64))
        out: list[tuple[int, ...]] = [()] * len(words)
        order = np.argsort(widths, kind="stable")
        at = 0
        while at < len(order):
            width = int(widths[order[at]])
            group = order[at : at + max(1, _SYMBOLS_AT_ONCE // width)]
            group = group[widths[group] == width]
            at += len(group)
            starts = ends[group] - lengths[group]
            if len(group) < _FEW and width >= _LONG:
                merged = (self._merge_one(symbols[a : a + n].tolist(), width) for a, n in zip(starts, lengths[group], strict=True))
            else:
                merged = self._merge(symbols, starts, lengths[group], width)
            for i, ids in zip(group.tolist(), merged, strict=True):
                out[i] = ids
        return out

    def _merge_one(self, symbol: list[int], width: int) -> tuple[int, ...]:
        """The same merges in one long word, a step at a time: there a step over arrays would serve a single merge."""
        n, known, merged = len(symbol), self.rank_of, self.merged_list
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        tree = [NO_PAIR] * (2 * width)
        tree[width : width + n - 1] = [known.get(a << 32 | b, NO_PAIR) for a, b in zip(symbol, symbol[1:])]
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def update(place: int, rank: int) -> None:
            node = place + width
            tree[node] = rank
            while node > 1:
                least = min(tree[node], tree[node ^ 1])
                node >>= 1
                if tree[node] == least:
                    return
                tree[node] = least

        while tree[1] < NO_PAIR:
            rank, node = tree[1], 1
            while node < width:
                node *= 2
                if tree[node] != rank:
                    node += 1
            here = node - width
            there = after[here]
            follows, previous = after[there], before[here]
            symbol[here], symbol[there], after[here] = merged[rank], -1, follows
            update(there, NO_PAIR)
            if follows >= 0:
                before[follows] = here
                update(here, known.get(symbol[here] << 32 | symbol[follows], NO_PAIR))
            else:
                update(here, NO_PAIR)
            if previous >= 0:
                update(previous, known.get(symbol[previous] << 32 | symbol[here], NO_PAIR))
        return tuple([self.numbers[i] for i in symbol if i >= 0])

    def _merge(self, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int) -> Iterator[tuple[int, ...]]:
        """Merge words of at most ``width`` symbols, a power of two."""
        n = len(starts)
        place = np.arange(width)
        inside = place < lengths[:, None]
        symbol = np.where(inside, symbols[np.minimum(starts[:, None] + place, len(symbols) - 1)], np.int32(-1))
        after = np.where(place + 1 < lengths[:, None], place + 1, -1).astype(np.int32)
        before = np.tile((place - 1).astype(np.int32), (n, 1))
        # node k has the children 2k and 2k + 1; the leaf of the pair that begins at place p is width + p
        tree = np.full((n, 2 * width), NO_PAIR, np.int32)
        tree[:, width:-1] = self.ranks(symbol[:, :-1], symbol[:, 1:])
        level = width
        while level > 1:
            tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level //= 2
        live = np.flatnonzero(tree[:, 1] < NO_PAIR)
        while len(live):
            rank = tree[live, 1]
            node = np.ones(len(live), np.int64)
            for _ in range(width.bit_length() - 1):
                node = 2 * node
                node += tree[live, node] != rank
            here = node - width
            there = after[live, here]
            follows = after[live, there]
            symbol[live, here] = self.merged[rank]
            symbol[live, there] = -1
            after[live, here] = follows
            more = follows >= 0
            before[live[more], follows[more]] = here[more]
            previous = before[live, here]
            self._update(tree, live, here, symbol[live, here], np.where(more, symbol[live, follows], -1))
            self._update(tree, live, there, np.full(len(live), -1, np.int32), symbol[live, there])
            led = previous >= 0
            rows_led = live[led]
            self._update(tree, rows_led, previous[led], symbol[rows_led, previous[led]], symbol[rows_led, here[led]])
            live = live[tree[live, 1] < NO_PAIR]
        kept = symbol >= 0
        ends = np.cumsum(kept.sum(axis=1)).tolist()
        ids = symbol[kept].tolist()
        ids = list(map(self.numbers.__getitem__, ids))  # one object per id, as encoded words are kept
        return (tuple(ids[a:b]) for a, b in zip([0, *ends[:-1]], ends, strict=True))

    def _update(self, tree: np.ndarray, rows: np.ndarray, place: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
        node = place + tree.shape[1] // 2
        tree[rows, node] = self.ranks(left, right)
        node = node >> 1
        while len(node) and node[0] > 0:  # all leaves are equally deep
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
            node = node >> 1

    def pieces(self, text: str) -> Iterator[tuple[str, int | None]]:
        """Runs of ordinary text, and special tokens with their id."""
        at = 0
        for found in self.cut.finditer(text) if self.cut else ():
            yield text[at : found.start()], None
            yield found[0], self.special[found[0]]
            at = found.end()
        yield text[at:], None


class Codec:
    """Encodes and decodes texts, keeping the pieces it has met in two generations of bounded size.

    A text is first split at white space, over which no rule of these files reaches: pieces are
    normalised, split into words and merged once, and then looked up. The four control characters
    that only Python takes for white space make a text go as one piece.
    """

    def __init__(self, vocabulary: Vocabulary, cached: int = CACHED_PIECES):
        self.vocabulary = vocabulary
        self.cached = cached
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.numbers = list(map(str, vocabulary.numbers))
        self.names = [vocabulary.tokens.get(i, "") for i in vocabulary.numbers]

    def _words(self, piece: str) -> list[str | int]:
        v = self.vocabulary
        out: list[str | int] = []
        for part, special in v.pieces(piece):
            if special is not None:
                out.append(special)
            elif part:
                out += v.words(v.normalise.normalize_str(part))
        return out

    def _split(self, pieces: list[str]) -> list[list[str | int]]:
        """The words and special tokens of each piece; all are normalised at once where that is the same."""
        v, joined = self.vocabulary, "\n".join(pieces)
        if not (v.cut and v.cut.search(joined)) and not _CONTROLS.search(joined):
            normal = v.normalise.normalize_str(joined).split(" ")
            if len(normal) == len(pieces):
                return list(map(v.words, normal))
        return list(map(self._words, pieces))

    def _learn(self, pieces: list[str]) -> None:
        split = self._split(pieces)
        words = list({w for words in split for w in words if w.__class__ is str})
        ids = dict(zip(words, self.vocabulary.encode_words(words), strict=True))
        for token in self.vocabulary.special.values():
            ids[token] = (token,)
        for piece, words in zip(pieces, split, strict=True):
            self.known[piece] = ids[words[0]] if len(words) == 1 else tuple([i for w in words for i in ids[w]])

    def encode(self, texts: Sequence[str | None]) -> Iterator[list[int]]:
        """The ids of each text; null has none."""
        for at, last in _portions(texts):
            split = [([t] if _CONTROLS.search(t) else t.split()) if t else [] for t in texts[at:last]]
            if len(self.known) > self.cached:
                self.known, self.older = {}, self.known
            known, older = self.known, self.older
            missing = set().union(*split).difference(known)
            for piece in missing & older.keys():
                known[piece] = older[piece]
                missing.discard(piece)
            if missing:
                self._learn(list(missing))
            for pieces in split:
                yield list(chain.from_iterable(map(known.__getitem__, pieces)))

    def decode(self, ids: Sequence[int]) -> str:
        """Tokens joined by one space, special ones among them."""
        return " ".join(map(self.names.__getitem__, ids))

    def decimal(self, ids: Sequence[int]) -> str:
        return " ".join(map(self.numbers.__getitem__, ids))


def _portions(texts: Sequence[str | None], characters: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about so many characters, or one long text, each."""
    size = first = 0
    for i, text in enumerate(texts):
        length = len(text or "")
        if i > first and size + length > characters:
            yield first, i
            size, first = 0, i
        size += length
    if len(texts):
        yield first, len(texts)


# What can be asked for, with its type and how it comes from the ids.
OUTPUTS: dict[str, tuple[str, Callable]] = {
    "ids": ("array<int>", lambda codec, ids: np.array(ids, np.int32)),
    "n_tokens": ("long", lambda codec, ids: len(ids)),
    "decoded": ("string", lambda codec, ids: codec.decode(ids)),
    "ids_sha256": ("string", lambda codec, ids: _sha256(codec.decimal(ids))),
    "decoded_sha256": ("string", lambda codec, ids: _sha256(codec.decode(ids))),
}


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def code_texts(df: DataFrame, text: str, vocabulary: str, outputs: Sequence[str] = ("ids", "n_tokens", "decoded")) -> DataFrame:
    """``df`` packed as ``row``, with the ``outputs`` of its whole text, encoded and decoded again.

    ``vocabulary`` is the content of a vocabulary file. ``ids_sha256`` is that of the ids in decimal
    with one space between, ``decoded_sha256`` that of the decoded text. Null and empty texts have no
    ids and decode to "". Repeated rows are coded as often as they come; an empty table gives an empty one.
    """
    file = df.sparkSession.sparkContext.broadcast(vocabulary)  # a vocabulary file has a few MB
    makers = {name: OUTPUTS[name][1] for name in outputs}

    @F.pandas_udf(", ".join(f"{name} {OUTPUTS[name][0]}" for name in outputs))
    def convert(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = Codec(Vocabulary(file.value))
        for batch in batches:
            texts = [t if isinstance(t, str) else None for t in batch]
            del batch
            for at, last in _portions(texts):  # results leave the task in parts, not as a batch
                columns: dict[str, list] = {name: [] for name in makers}
                for ids in codec.encode(texts[at:last]):
                    for name, make in makers.items():
                        columns[name].append(make(codec, ids))
                yield pd.DataFrame(columns)

    packed = df.select(F.struct("*").alias("row"), convert(F.col(f"`{text}`")).alias("out"))
    return packed.select("row", "out.*")
