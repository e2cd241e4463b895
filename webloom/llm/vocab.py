"""Public tokenizers inside tasks: texts cut into units that no token crosses, each unit encoded once.

Both tokenizers never join what ends before a space with what begins at it. So a text is encoded by
units, a space with what follows it, and a worker keeps the units it has seen: most are words.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"
# A space that may belong to the unit before it: another blank follows, or nothing.
ROUGH = re.compile(r" (?:\s|\Z)")
# Cut only where a space follows something that is no blank.
UNIT = re.compile(r"\s*\S+(?:[^\S ]\s*\S+)*(?:\s+\Z)?|\s+\Z")
# Characters whose classes all Unicode versions agree on, but for controls that some take as blanks.
SETTLED = re.compile(r"[\x00-\x1b\x20-ſ]*\Z")
# A blank before a space or at the end.
LOOSE = re.compile(r"\s(?: |\Z)")
# The pattern that cuts a text before byte-pair merges; part of the vocabulary's format.
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Units that a worker keeps at most, and the longest kept.
KEPT, KEPT_LENGTH = 1_000_000, 48


def public_path(name: str) -> str:
    """Where the installed package of public vocabularies keeps a file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def units_of(text: str) -> list[str]:
    """The units of ``text``, all but the first without the space they begin with."""
    if not ROUGH.search(text):
        return text.split(" ")
    found = UNIT.findall(text)
    return [found[0], *[u[1:] for u in found[1:]]] if found else [""]


def byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others, in order, as the
    letters from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


class ByteVocabulary:
    """A byte-level BPE of the ``tokenizers`` library.

    Units of settled characters go through ``tiktoken`` with the same vocabulary as ranks, many in
    one call, if the merges' products are numbered in the order of the merges: the ids are the same
    then. All others go through the library itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        model = json.loads(self.library.to_str())["model"]
        letters = byte_of_letter()
        special = {t.content for t in self.library.get_added_tokens_decoder().values()}
        self.special = tuple(sorted(special))
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.token_bytes: list[bytes] = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            coded = token not in special and all(c in letters for c in token)
            self.token_bytes[number] = bytes(letters[c] for c in token) if coded else token.encode()
        self.lengths = np.array([len(b) for b in self.token_bytes], dtype=np.int64)
        merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
        products = [model["vocab"][m] for m in merged]
        self.ranked = products == sorted(products)
        self.ranks = {self.token_bytes[n]: n for t, n in model["vocab"].items() if t not in special}

    @cached_property
    def quick(self):
        import tiktoken

        return tiktoken.Encoding("units", pat_str=WORD_PATTERN, mergeable_ranks=self.ranks, special_tokens={})

    def whole(self, text: str, special: bool) -> np.ndarray:
        """Ids of a text by the library; with ``special``, the strings of special tokens are these."""
        self.library.encode_special_tokens = not special
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.int32)

    def encoded(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units in a row, and how many each has. Units are whole: no token crosses them."""
        flats, counts = [], np.zeros(len(units), dtype=np.int64)
        for first in range(0, len(units), 8192):
            some = units[first : first + 8192]
            flat, counts[first : first + len(some)] = self._run(some)
            flats.append(flat)
        return (np.concatenate(flats) if flats else np.zeros(0, dtype=np.int32)), counts

    def _together(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Units of settled characters that begin with a space and end with no blank: as one text."""
        joined = "".join(units)
        got = self.quick.encode_to_numpy(joined, disallowed_special=()).astype(np.int32)
        sizes = list(map(len, units)) if joined.isascii() else list(map(len, map(str.encode, units)))
        ends = np.searchsorted(np.cumsum(self.lengths[got]), np.cumsum(sizes)) + 1
        return got, np.diff(ends, prepend=0)

    def _run(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joined = "".join(units)
        whole = self.ranked and all(u[:1] == " " for u in units)
        if whole and SETTLED.match(joined) and not LOOSE.search(joined):
            return self._together(units)
        ids: list[np.ndarray] = [np.zeros(0, dtype=np.int32)] * len(units)
        others = []
        for i, unit in enumerate(units):
            if not self.ranked or not SETTLED.match(unit):
                ids[i] = self.whole(unit, special=False)
            elif unit[:1] == " " and not LOOSE.search(unit):
                others.append(i)
            else:
                ids[i] = np.array(self.quick.encode_ordinary(unit), dtype=np.int32)
        if others:
            flat, counts = self._together([units[i] for i in others])
            for i, part in zip(others, np.split(flat, np.cumsum(counts)[:-1])):
                ids[i] = part
        return np.concatenate(ids), np.array([len(x) for x in ids], dtype=np.int64)


class PieceVocabulary:
    """A sentencepiece model, which puts a space before each text."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        hexed = [re.fullmatch("<0x([0-9A-F]{2})>", p) for p in pieces]
        self.token_bytes = [
            bytes([int(h[1], 16)]) if h else p.replace("▁", " ").encode() for p, h in zip(pieces, hexed)
        ]
        self.lengths = np.array([len(b) for b in self.token_bytes], dtype=np.int64)
        # Units may be encoded apart if no piece has a space behind something else.
        self.by_units = not any(re.search("[^▁]▁", p) for p in pieces)

    def encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has."""
        ids = self.library.encode(texts, num_threads=1) if texts else []
        counts = np.array([len(x) for x in ids], dtype=np.int64)
        flat = np.fromiter((i for x in ids for i in x), dtype=np.int32, count=int(counts.sum()))
        return flat, counts


# Loaded once in a worker.
@lru_cache(maxsize=2)
def byte_vocabulary(path: str) -> ByteVocabulary:
    return ByteVocabulary(path)


@lru_cache(maxsize=2)
def piece_vocabulary(path: str) -> PieceVocabulary:
    return PieceVocabulary(path)


@dataclass
class Words:
    """The units of some texts: distinct ones once, and of each text the numbers of its own in a row.

    Texts come in the order ``order``; ``ends`` are their ends among ``index``, from 0.
    """

    keys: list[str]
    index: np.ndarray
    ends: np.ndarray
    order: np.ndarray

    @classmethod
    def of(cls, texts: list[str], leading: bool = False) -> Words:
        """With ``leading``, all texts begin with a space, which is left off like those of other units."""
        rough = np.array([ROUGH.search(t) is not None for t in texts], dtype=bool)
        order = np.argsort(rough, kind="stable")
        smooth = len(texts) - int(rough.sum())
        cut = pc.split_pattern(pa.array([texts[i][leading:] for i in order[:smooth]], type=pa.large_string()), " ")
        units = [units_of(texts[i]) for i in order[smooth:]]
        if leading:
            units = [[x[0][1:], *x[1:]] for x in units]
        flat = pa.concat_arrays([cut.flatten(), pa.array([u for x in units for u in x], type=pa.large_string())])
        sizes = np.concatenate([np.diff(cut.offsets.to_numpy()), [len(x) for x in units]]).astype(np.int64)
        coded = flat.dictionary_encode()
        return cls(
            coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy(), np.concatenate([[0], np.cumsum(sizes)]), order
        )


def gathered(flat: np.ndarray, sizes: np.ndarray, index: np.ndarray) -> np.ndarray:
    """The runs ``index`` of ``flat``, one behind the other; run i has ``sizes[i]`` values. Fewer than
    2**31 values are gathered, as slices of batches are."""
    starts, taken = np.cumsum(sizes) - sizes, sizes[index]
    shift = (starts[index] - (np.cumsum(taken) - taken)).astype(np.int32)
    return flat[np.repeat(shift, taken) + np.arange(int(taken.sum()), dtype=np.int32)]


class Memory:
    """What a worker has learnt about units, made by ``learn`` for many at once. Long units are learnt
    anew each time, and everything is when there is too much."""

    def __init__(self, learn: Callable[[list[str]], list], kept: int = KEPT):
        self.learn, self.kept, self.seen = learn, kept, {}

    def of(self, keys: list[str]) -> list:
        if len(self.seen) > self.kept:
            self.seen.clear()
        seen = self.seen
        missing = [k for k in keys if k not in seen]
        short = [k for k in missing if len(k) <= KEPT_LENGTH]
        seen.update(zip(short, self.learn(short)))
        if len(short) == len(missing):
            return [seen[k] for k in keys]
        rest = [k for k in missing if len(k) > KEPT_LENGTH]
        longer = dict(zip(rest, self.learn(rest)))
        return [longer[k] if k in longer else seen[k] for k in keys]


class IdBytes:
    """Ids of texts as little-endian unsigned 32-bit integers, unit by unit; a worker keeps one."""

    def __init__(self, path: str):
        self.vocabulary = byte_vocabulary(path)
        self.memory = Memory(self._learn)

    def _learn(self, keys: list[str]) -> list[bytes]:
        flat, counts = self.vocabulary.encoded([" " + k for k in keys])
        raw = flat.astype("<u4").tobytes()
        ends = (4 * np.cumsum(counts)).tolist()
        return [raw[a:b] for a, b in zip([0, *ends[:-1]], ends)]

    def of(self, texts: list[str]) -> list[bytes]:
        """Strings of special tokens in a text are these tokens, as the library has it."""
        special = self.vocabulary.special
        apart = [i for i, t in enumerate(texts) if any(s in t for s in special)]
        result = {i: self.vocabulary.whole(texts[i], special=True).astype("<u4").tobytes() for i in apart}
        rest = [i for i in range(len(texts)) if i not in result]
        if rest:
            words = Words.of([texts[i] for i in rest])
            # The first unit of a text has no space before it.
            heads = words.ends[:-1]
            first = [words.keys[k] for k in words.index[heads]]
            flat, counts = self.vocabulary.encoded([k for k in first if k])
            before = iter(np.split(flat, np.cumsum(counts)[:-1]))
            follows = np.ones(len(words.index), dtype=bool)
            follows[heads] = False
            known = self.memory.of(words.keys)
            sizes = np.array([len(x) // 4 for x in known], dtype=np.int64)
            index = words.index[follows]
            flat = gathered(np.frombuffer(b"".join(known), dtype="<u4"), sizes, index)
            ends = np.concatenate([[0], np.cumsum(sizes[index])])[words.ends - np.arange(len(words.ends))]
            raw = flat.tobytes()
            for place, head, a, b in zip(words.order.tolist(), first, ends[:-1].tolist(), ends[1:].tolist()):
                start = next(before).astype("<u4").tobytes() if head else b""
                result[rest[place]] = start + raw[4 * a : 4 * b]
        return [result[i] for i in range(len(texts))]


@lru_cache(maxsize=1)
def id_bytes(path: str) -> IdBytes:
    return IdBytes(path)
