"""Token counts by a compiled finite-state tokenizer (operator 13).

A byte-level BPE vocabulary becomes a deterministic transducer over bytes. The
encoding of a prefix is the encoding of a shorter prefix and one more token,
so a state is what can still matter of that: for each open start of a token,
its node in the vocabulary's trie, the token before it, and how many tokens
fewer its prefix has. A transition's annotation is the number of tokens that the
byte adds, which may be negative. Texts are cut into chunks, each chunk's map of
entering to leaving state and count comes from running all chunks side by side,
and the maps of one text are composed by a prefix scan.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landquill.llm.textbytes import text_buffer

#: Bytes that are in work at once, of however many or long texts, and bytes of one chunk.
WINDOW_BYTES, CHUNK = 1 << 20, 128
#: Bytes before a chunk that begins inside a piece; run first, to guess the state that it is entered in.
WARM = 48
#: States after which a task forgets its transitions and begins anew.
MOST_STATES = 500_000
LETTER, NUMBER, OTHER, SPACE = range(4)
_CONTEXT = 64
_SPREAD = 0x9E3779B97F4A7C15
#: Tokens below a node of the trie up to which states are told apart only by what can follow there.
_FEW = 12


@dataclass
class Vocabulary:
    """What the tasks get: tokens as bytes, merges in their order as (left, right, result), single tokens, kinds of characters as runs."""

    tokens: dict[int, bytes]
    merges: list[tuple[int, int, int]]
    specials: list[bytes]
    run_starts: list[int]
    run_kinds: list[int]
    key: str = ""


def _alphabet() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable bytes for themselves, the others in order from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def _kinds(pre_tokenizer) -> tuple[list[int], list[int]]:
    """Runs of code points of one kind, as the tokenizer itself tells letters, numbers, white space and others apart."""
    before = {LETTER: "a", NUMBER: "1", OTHER: "!", SPACE: "\n"}
    found: list[tuple[int, int]] = []

    def is_one(kind: int, chars: str) -> bool:
        return len(pre_tokenizer.pre_tokenize_str(before[kind] + chars + "\n" * (kind == SPACE))) == 1

    def ask(first: int, last: int, guess: int) -> None:
        """Kinds of the code points first to last: of all at once if the guess holds, else of both halves."""
        if is_one(guess, "".join(map(chr, range(first, last + 1)))):
            found.append((first, guess))
        elif first == last:
            found.append((first, next((k for k in before if is_one(k, chr(first))), OTHER)))
        else:
            middle = (first + last) // 2
            ask(first, middle, guess)
            ask(middle + 1, last, guess)

    def likely(c: int) -> int:
        return SPACE if chr(c).isspace() and not 0x1C <= c < 0x20 else {"L": LETTER, "N": NUMBER}.get(unicodedata.category(chr(c))[0], OTHER)

    guesses = np.array([OTHER if 0xD800 <= c < 0xE000 else likely(c) for c in range(0x110000)])
    edges = sorted({*np.flatnonzero(np.diff(guesses, prepend=-1)).tolist(), 0xD800, 0xE000, 0x110000})
    for first, end in zip(edges, edges[1:]):
        if first == 0xD800:  # surrogates are no characters
            found.append((first, OTHER))
        else:
            ask(first, end - 1, int(guesses[first]))
    return [c for c, _ in found], [k for _, k in found]


def vocabulary(path: str) -> Vocabulary:
    """Reads a byte-level BPE file of the library ``tokenizers``; ValueError for what the transducer wouldn't count alike."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        raw = f.read()
    spec = json.loads(raw)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    if model.get("type") != "BPE" or not plain or spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
        raise ValueError(f"{path} is no plain byte-level BPE")
    letters = _alphabet()
    tokens = {i: bytes(letters[c] for c in t) for t, i in model["vocab"].items() if all(c in letters for c in t)}
    number = model["vocab"]
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    merges = [(number[a], number[b], number[a + b]) for a, b in pairs]
    if len({m[2] for m in merges}) < len(merges) or len({t for t in tokens.values() if len(t) == 1}) < 256:
        raise ValueError(f"{path}: a token of several merges, or a byte without a token")
    specials = [t["content"].encode() for t in spec.get("added_tokens", [])]
    if any(t.get("single_word") or t.get("lstrip") or t.get("rstrip") or t.get("normalized") for t in spec.get("added_tokens", [])):
        raise ValueError(f"{path}: added tokens with conditions")
    if any(a[-n:] == b[:n] for a in specials for b in specials for n in range(1, min(len(a), len(b)) + (a is not b))) or any(a in b for a in specials for b in specials if a is not b):
        raise ValueError(f"{path}: added tokens that overlap")
    starts, kinds = _kinds(Tokenizer.from_str(raw).pre_tokenizer)
    return Vocabulary(tokens, merges, specials, starts, kinds, hashlib.md5(raw.encode()).hexdigest())


class Transducer:
    """Transitions (state, byte) -> (state, tokens added), worked out when first met; state 0 is the begin of a piece."""

    def __init__(self, vocab: Vocabulary) -> None:
        self.vocab = vocab
        self.kind = np.repeat(np.array(vocab.run_kinds, np.uint8), np.diff([*vocab.run_starts, 0x110000]))
        self._pair = {(a, b): (rank, t) for rank, (a, b, t) in enumerate(vocab.merges)}
        made = {t: (a, b, rank) for rank, (a, b, t) in enumerate(vocab.merges)}
        single = [t for t in vocab.tokens if len(vocab.tokens[t]) == 1]
        #: For each token its edge, from one byte to itself, as (token, rank of the merge that takes it in).
        self._right: dict[int, list[tuple[int, float]]] = {t: [(t, float("inf"))] for t in single}
        self._left = dict(self._right)
        for t, (a, b, rank) in made.items():  # in the order of the merges, so parts come before wholes
            if a in self._right and b in self._left and self._meets(a, b) == (a, b):
                self._right[t] = [*self._right[b][:-1], (b, rank), (t, float("inf"))]
                self._left[t] = [*self._left[a][:-1], (a, rank), (t, float("inf"))]
        self._fits: dict[tuple[int, int], bool] = {}
        self._alike: dict[tuple[int, int], int] = {}
        self._child: dict[int, int] = {}
        self._token, self._below = [-1], [[]]
        for t in self._right:
            node = 0
            for byte in vocab.tokens[t]:
                if len(self._below[node]) <= _FEW:
                    self._below[node].append(t)
                key = node << 8 | byte
                if key not in self._child:
                    self._child[key] = len(self._token)
                    self._token.append(-1)
                    self._below.append([])
                node = self._child[key]
            self._token[node] = t
        self.forget()

    def forget(self) -> None:
        first = struct.pack("iii", 0, -1, 0)
        self._alike.clear()
        self._like: dict[tuple[int, int], int] = {}
        self._numbers, self._states = {first: 0}, [first]
        self._known: dict[int, int] = {}
        self._keys, self._values = np.full(1 << 16, -1, np.int64), np.zeros(1 << 16, np.int64)

    def _meets(self, a: int, b: int) -> tuple[int, int] | None:
        """The edges of two tokens side by side that merge first across the border; None if none do."""
        right, left, m, n = self._right[a], self._left[b], 0, 0
        while True:
            (x, out), (y, in_) = right[m], left[n]
            hit = self._pair.get((x, y))
            if hit and hit[0] < out and hit[0] <= in_:  # of equal merges the one more to the left comes first
                return x, y
            if out <= in_:
                if m + 1 == len(right):
                    return None
                m += 1
            else:
                n += 1

    def _stays(self, a: int, b: int) -> bool:
        key = (a, b)
        if key not in self._fits:
            if len(self._fits) > 2_000_000:
                self._fits.clear()
            self._fits[key] = self._meets(a, b) is None
        return self._fits[key]

    def _kin(self, node: int, before: int) -> int:
        """The first token met that goes with the same tokens below a node as ``before`` does; -2 if none can follow there."""
        key = (node, before)
        if key not in self._alike:
            marks = 0
            for t in self._below[node]:
                marks = marks << 1 | (before < 0 or self._stays(before, t))
            self._alike[key] = self._like.setdefault((node, marks), before) if marks else -2
        return self._alike[key]

    def step(self, state: int, byte: int) -> tuple[int, int]:
        key = state << 8 | byte
        packed = self._known.get(key)
        if packed is None:
            packed = self._work_out(state, byte)
            self._known[key] = packed
            if 2 * len(self._known) > len(self._keys):
                self._keys, self._values = np.full(4 * len(self._keys), -1, np.int64), np.zeros(4 * len(self._keys), np.int64)
                for k, v in self._known.items():
                    self._put(k, v)
            else:
                self._put(key, packed)
        return packed >> 8, (packed & 255) - 128

    def _work_out(self, state: int, byte: int) -> int:
        flat = self._states[state]
        entries = struct.unpack(f"{len(flat) // 4}i", flat)
        live, token, add = [], -1, 0
        for k in range(0, len(entries), 3):
            before = entries[k + 1]
            node = self._child.get(entries[k] << 8 | byte)
            if node is None:
                continue
            t = self._token[node]
            if token < 0 and t >= 0 and (before < 0 or self._stays(before, t)):
                token, add = t, entries[k + 2] + 1
            if 0 < len(self._below[node]) <= _FEW:
                before = self._kin(node, before)
            if self._below[node] and before > -2:
                live.append((node, before, entries[k + 2]))
        out = [x for node, before, less in live for x in (node, before, less - add)] + [0, token, 0]
        packed = struct.pack(f"{len(out)}i", *out)
        number = self._numbers.setdefault(packed, len(self._states))
        if number == len(self._states):
            self._states.append(packed)
        return number << 8 | add + 128

    def _put(self, key: int, value: int) -> None:
        mask = len(self._keys) - 1
        slot = (key * _SPREAD & 0xFFFFFFFFFFFFFFFF) >> 64 - mask.bit_length()
        while self._keys[slot] >= 0:
            slot = slot + 1 & mask
        self._keys[slot], self._values[slot] = key, value

    def _take(self, keys: np.ndarray) -> np.ndarray:
        """The packed transitions of many keys at once."""
        mask = len(self._keys) - 1
        slot = ((keys.astype(np.uint64) * np.uint64(_SPREAD)) >> np.uint64(64 - mask.bit_length())).astype(np.int64)
        held = self._keys[slot]
        out = self._values[slot]
        todo = np.flatnonzero(held != keys)
        if len(todo):
            missing, at, place = [], slot[todo], todo
            while len(place):
                new = self._keys[at] < 0
                missing.append(place[new])
                place, at = place[~new], at[~new] + 1 & mask
                hit = self._keys[at] == keys[place]
                out[place[hit]] = self._values[at[hit]]
                place, at = place[~hit], at[~hit]
            missing = np.concatenate(missing)
            if len(missing):
                which, back = np.unique(keys[missing], return_inverse=True)
                packed = [a << 8 | b + 128 for a, b in (self.step(k >> 8, k & 255) for k in which.tolist())]
                out[missing] = np.array(packed)[back]
        return out

    def run(self, data: np.ndarray, begins: np.ndarray, starts: np.ndarray, ends: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(leaving states, tokens added) of data[start:end] side by side; at a begin of a piece the state is 0 again."""
        order = np.argsort(starts - ends, kind="stable")  # the longest first, so that those still running are a prefix
        at, length, now = starts[order], (ends - starts)[order], state[order].astype(np.int64)
        count = np.zeros(len(at), np.int64)
        running = len(at) - np.searchsorted(length[::-1], np.arange(1, length.max(initial=0) + 1))
        for p, n in enumerate(running.tolist()):
            if n < 8:  # few are left: one after another
                for k in range(n):
                    s, c = int(now[k]), 0
                    for x, new in zip(data[at[k] + p : at[k] + length[k]].tolist(), begins[at[k] + p : at[k] + length[k]].tolist()):
                        packed = self._known.get((0 if new else s << 8) | x)
                        s, add = self.step(0 if new else s, x) if packed is None else (packed >> 8, (packed & 255) - 128)
                        c += add
                    now[k] = s
                    count[k] += c
                break
            place = at[:n] + p
            packed = self._take(np.where(begins[place], 0, now[:n] << 8) | data[place])
            now[:n] = packed >> 8
            count[:n] += (packed & 255) - 128
        left, out = np.empty_like(now), np.empty_like(count)
        left[order], out[order] = now, count
        return left, out


def _decoded(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of the first bytes of characters, code points)."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    wide = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.int32)
    first = wide[at]
    point = first.copy()
    for more, low, bits in ((1, 0xC0, 0x1F), (2, 0xE0, 0x0F), (3, 0xF0, 0x07)):
        k = np.flatnonzero(first >= low)
        if len(k):
            value = first[k] & bits
            for m in range(1, more + 1):
                value = value << 6 | wide[at[k] + m] & 0x3F
            point[k] = value
    return at, np.minimum(point, 0x10FFFF)


def _shifted(x: np.ndarray, by: int, fill: object) -> np.ndarray:
    out = np.full_like(x, fill)
    if by < len(x):
        out[: len(x) - by] = x[by:]
    return out


def pieces(data: np.ndarray, text_starts: np.ndarray, kind: np.ndarray, specials: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """(flag of the bytes that begin a piece, flag of the bytes of single tokens, where those begin).

    A piece is a contraction, a run of letters, of numbers or of others with one
    space before it, or white space; the last white space before another
    character stands alone, or is that one space.
    """
    begins, skip, found = np.zeros(len(data) + 1, bool), np.zeros(len(data), bool), []
    edge = np.zeros(len(data) + 1, bool)
    edge[text_starts] = True
    if specials:
        raw = data.tobytes()
        for s in specials:
            k = raw.find(s)
            while k >= 0:
                if not edge[k + 1 : k + len(s)].any():
                    found.append(k)
                    skip[k : k + len(s)] = True
                    edge[k] = edge[k + len(s)] = True
                    k += len(s) - 1
                k = raw.find(s, k + 1)
    at, point = _decoded(data)
    if not len(at):
        return begins[:-1], skip, found
    own, fresh = kind[point], edge[at]
    new = fresh.copy()
    new[0] = True
    new[1:] |= own[1:] != own[:-1]
    after = np.flatnonzero((own[1:] != SPACE) & (own[:-1] == SPACE) & ~fresh[1:]) + 1
    new[after - 1] = True
    new[after[point[after - 1] == 0x20]] = False
    quote = np.flatnonzero(new & (point == 0x27))
    if len(quote):
        one, two = _shifted(point, 1, 0)[quote], _shifted(point, 2, 0)[quote]
        in1, in2 = ~_shifted(fresh, 1, True)[quote], ~_shifted(fresh, 2, True)[quote]
        short = in1 & np.isin(one, [ord(c) for c in "stmd"])
        long = in1 & in2 & (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l")))
        new[quote[short | long] + 1] = False
        ends = np.concatenate([quote[short] + 2, quote[long] + 3])
        new[ends[ends < len(new)]] = True
    begins[at[new]] = True
    return begins[:-1], skip, found


def _counted(machine: Transducer, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Tokens of each text; windows of bounded size are in work one after another, however long a text is."""
    total = np.zeros(len(offs) - 1, np.int64)
    a, state = int(offs[0]), 0
    while a < offs[-1]:
        b = min(int(offs[-1]), a + WINDOW_BYTES)
        while b < offs[-1] and data[b] & 0xC0 == 0x80:
            b -= 1
        lo, hi = max(int(offs[0]), a - _CONTEXT), min(int(offs[-1]), b + _CONTEXT)
        while lo < a and data[lo] & 0xC0 == 0x80:
            lo += 1
        near = offs[(offs >= lo) & (offs < hi)] - lo
        begins, skip, found = pieces(data[lo:hi], near, machine.kind, machine.vocab.specials)
        here, flags = data[a:b], begins[a - lo : b - lo]
        for k in found:
            if a <= k + lo < b:
                total[np.searchsorted(offs, k + lo, "right") - 1] += 1
        first, last = np.searchsorted(offs, a, "right") - 1, np.searchsorted(offs, b, "left")
        bounds = np.clip(offs[first : last + 1] - a, 0, b - a)
        gone = skip[a - lo : b - lo]
        if gone.any():
            kept = np.concatenate([[0], np.cumsum(~gone)])
            flags = np.concatenate([flags, [False]])
            flags[:-1][gone] = False
            here, flags, bounds = here[~gone], flags[:-1][~gone], kept[bounds]
        added, state = _composed(machine, here, flags, bounds, state)
        total[first:last] += added
        if hi > b and (begins[b - lo] or skip[b - lo]):
            state = 0
        a = b
    return total


def _composed(machine: Transducer, data: np.ndarray, begins: np.ndarray, bounds: np.ndarray, state: int) -> tuple[np.ndarray, int]:
    """(tokens added in each of the texts at ``bounds``, leaving state), entered in ``state``."""
    out = np.zeros(len(bounds) - 1, np.int64)
    if not len(data):
        return out, state
    if len(machine._states) > MOST_STATES:
        held = machine._states[state]
        machine.forget()
        if state:
            machine._states.append(held)
            machine._numbers[held] = state = 1
    marks = np.flatnonzero(begins)
    grid = np.arange(0, len(data), CHUNK)
    cuts = marks[np.minimum(np.searchsorted(marks, grid), len(marks) - 1)] if len(marks) else grid[:0]
    starts = np.unique(np.concatenate([[0], cuts, bounds[:-1][bounds[:-1] < len(data)]]))
    long = np.flatnonzero(np.diff([*starts, len(data)]) > 4 * CHUNK)  # inside long pieces chunks begin anywhere
    inner = [np.arange(starts[k] + 2 * CHUNK, ([*starts, len(data)])[k + 1] - CHUNK, 2 * CHUNK) for k in long]
    starts = np.unique(np.concatenate([starts, *inner]))
    ends = np.append(starts[1:], len(data))
    enter = np.zeros(len(starts), np.int64)
    enter[0] = state
    loose = np.flatnonzero(~begins[starts])
    loose = loose[loose > 0]
    if len(loose):
        enter[loose] = machine.run(data, begins, np.maximum(starts[loose] - WARM, 0), starts[loose], np.zeros(len(loose), np.int64))[0]
    leave, count = machine.run(data, begins, starts, ends, enter)
    # The scan: a chunk's map is known for one entering state, and for any if it begins a piece. Where the chunk
    # before leaves in another state, the map is extended at that state.
    for k in loose[leave[loose - 1] != enter[loose]].tolist():
        now = k
        while now < len(starts) and not begins[starts[now]] and leave[now - 1] != enter[now]:
            enter[now] = leave[now - 1]
            x, c = machine.run(data, begins, starts[now : now + 1], ends[now : now + 1], enter[now : now + 1])
            leave[now], count[now] = x[0], c[0]
            now += 1
    sums = np.concatenate([[0], np.cumsum(count)])
    return np.diff(sums[np.searchsorted(starts, bounds)]), int(leave[-1])


_machines: dict[str, Transducer] = {}


def _counter(shared):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        if vocab.key not in _machines:
            _machines.clear()
            _machines[vocab.key] = Transducer(vocab)
        for batch in batches:
            data, offs = text_buffer(batch.column("_text"))
            n = _counted(_machines[vocab.key], data, offs)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(np.diff(offs)), pa.array(n)], names=["_id", "n_bytes", "n_tokens"])

    return count


def token_counts(docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit`` tokens) of each text.

    ``path`` is a byte-level BPE file of the library ``tokenizers``; it is read on the
    driver, and the vocabulary, whose size doesn't depend on the corpus, is broadcast. Counts are those of the
    library without added tokens at either end; strings of special tokens inside a text are one token each.

    Null and empty texts have no bytes and no tokens; repeated rows are counted each; an empty table
    gives an empty one; other columns of ``docs``, whatever their names, play no part. A text of any length is worked
    through in windows of 1 MiB; what passes from one to the next is one state.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(path))
    asked = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    kind = asked.schema["_id"].dataType.simpleString()
    found = asked.mapInArrow(_counter(shared), f"_id {kind}, n_bytes long, n_tokens long")
    return found.select(F.col("_id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
