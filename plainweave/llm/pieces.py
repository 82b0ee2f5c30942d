"""Encoding into the pieces of a merge-type SentencePiece model, and back.

The encoding of every prefix of a text ends in one token only. A table with
that token for each prefix is filled from left to right: an automaton gives
the tokens that end at a place, and one of them fits if it is compatible with
the last token of the prefix before it, that is, if merging the two tokens'
text gives the two tokens again. Reading the table backwards gives the ids.

No piece holds a space mark after another character, so merges never cross
from a character to a following space mark, and the text is encoded in runs
of space marks with the characters that follow them, and these in parts between
characters that no piece has side by side. The tables of many parts are filled
together, the first place of all, then the second and so on; that of a part of
more than SHORT characters is filled alone. A task keeps the runs it has met, in two
generations bounded by bytes: what is met again moves from the old one to the
new, and the old one goes when the new one is full. These hold ids only: every
row is decoded from its own ids, the rows of a slice together.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from plainweave.llm import words as W

MARK = "▁"
RUN = re.compile(f"{MARK}+[^{MARK}]*")
KNOWN_BYTES = 6 << 20  # of a generation of runs, with ENTRY for each
KNOWN_PAIRS = 60_000  # of a generation
KNOWN_FITS = 1 << 19  # places for pairs that parts filled together have met
TOGETHER = 1 << 17  # characters of parts that are filled at once
SHORT = 64  # characters of a part that is filled with others
ENTRY = 200
PLACES = 1 << 22
NEVER = 1 << 30
SLICE_BYTES = 1 << 18  # of texts that are encoded and decoded at once
UNKNOWN = " ⁇ "  # what the unknown piece decodes to
COLUMNS = ["n_tokens", "ids", "ids_sha256", "decoded_sha256"]


def place(first, second):
    """Of a pair of characters, in a table of PLACES."""
    return (first * 40_503 + second * 2_654_435_761) % PLACES


class Numbers:
    """A number for each of many keys, looked up for a whole array at once; -1
    for any other key. Three quarters of the places at least stay free."""

    def __init__(self, keys: list[int], values: list[int]):
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, -1, np.int32)
        rest, given = np.array(keys, np.int64), np.array(values, np.int32)
        at = spread(rest, self.bits)
        while len(rest):
            free = self.keys[at] < 0
            self.keys[at[free]] = rest[free]
            held = self.keys[at] == rest
            self.values[at[held]] = given[held]
            rest, given, at = rest[~held], given[~held], (at[~held] + 1) & (len(self.keys) - 1)

    def get(self, keys: np.ndarray) -> np.ndarray:
        at = spread(keys, self.bits)
        held = self.keys[at]
        out = np.where(held == keys, self.values[at], np.int32(-1))
        rest = np.flatnonzero((held != keys) & (held >= 0))
        while len(rest):
            at[rest] = (at[rest] + 1) & (len(self.keys) - 1)
            held = self.keys[at[rest]]
            same = held == keys[rest]
            out[rest[same]] = self.values[at[rest[same]]]
            rest = rest[~same & (held >= 0)]
        return out


def spread(keys: np.ndarray, bits: int) -> np.ndarray:
    """A place below 2**bits for each key."""
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


class Generations:
    """Texts with their decimal ids: the present generation and the one before,
    of which each is bounded by bytes."""

    def __init__(self, limit: int):
        self.limit, self.held = limit, 0
        self.ids: dict[str, str] = {}
        self.before: dict[str, str] = {}

    def put(self, key: str, ids: str) -> str:
        self.ids[key] = ids
        self.held += ENTRY + len(key) + len(ids)
        return ids

    def recall(self, key: str) -> str | None:
        """What the generation before knows moves to the present one."""
        ids = self.before.get(key)
        return None if ids is None else self.put(key, ids)

    def turn(self) -> None:
        """Begins a new generation if the present one is full."""
        if self.held > self.limit:
            self.before, self.ids, self.held = self.ids, {}, 0


class Pieces:
    """Vocabulary of a model file: pieces, merge scores and byte pieces."""

    def __init__(self, model: bytes):
        import sentencepiece

        read = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.surface: dict[int, str] = {}
        self.byte_ids: list[int] = [0] * 256
        self.byte_of: dict[int, int] = {}
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.unknown = read.unk_id()
        self.count = read.get_piece_size()
        for i in range(read.get_piece_size()):
            piece = read.id_to_piece(i)
            if read.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.byte_of[i] = int(piece[3:5], 16)
            elif not (read.is_control(i) or read.is_unknown(i) or read.is_unused(i)):
                self.ids[piece] = i
                self.score[piece] = read.get_score(i)
                self.surface[i] = piece.replace(MARK, " ")
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("pieces with a space mark inside need another way to cut texts")
        # how each piece is made: the last merge of its own text
        self.parts: dict[str, tuple[str, str]] = {}
        for piece in self.ids:
            made = self.merged(piece, 2) if len(piece) > 1 else [piece]
            if len(made) == 2:
                self.parts[piece] = (made[0], made[1])
        # characters that stand side by side in some piece
        self.inside = np.unique([place(ord(p[k]), ord(p[k + 1])) for p in self.ids for k in range(len(p) - 1)] or [0])
        self.beside = None
        self._number()
        self.forget()
        self.automaton = self.raw = None

    def _number(self) -> None:
        """Tokens as numbers: pieces by id, then characters that only occur
        inside pieces, then one number for all other characters."""
        chars = {c for p in self.ids for c in p}
        only = sorted(chars.difference(self.ids))
        first = max(self.ids.values(), default=0) + 1
        self.number = self.ids | {c: first + k for k, c in enumerate(only)}
        self.other = first + len(only)
        size = self.other + 1
        self.base = size
        self.length, self.names = [1] * size, [""] * size
        self.rank, self.made = [-1.0] * size, [(0, 0)] * size
        self.marks = [False] * size
        self.piece = [""] * size
        for text, n in self.number.items():
            self.length[n], self.piece[n] = len(text), text
            self.marks[n] = not text.strip(MARK)
            if text in self.ids:
                self.names[n] = str(n)
            if text in self.parts:
                self.rank[n] = -self.score[text]
                self.made[n] = tuple(self.number[x] for x in self.parts[text])
        # rank of every piece by any two tokens that it can be cut into
        self.joins: dict[int, float] = {}
        for text in self.ids:
            for k in range(1, len(text)):
                left, right = self.number.get(text[:k]), self.number.get(text[k:])
                if left is not None and right is not None:
                    self.joins[left * size + right] = -self.score[text]

    def __getstate__(self):
        met = {"fits": {}, "fits_before": {}, "known": None, "pairs": None}
        return self.__dict__ | met | {"automaton": None, "beside": None, "raw": None}

    def ready(self) -> "Pieces":
        """With the automaton over the pieces of two characters and more."""
        import ahocorasick

        if self.known is None:
            self.forget()
        if self.beside is None:
            self.beside = np.zeros(PLACES, bool)
            self.beside[self.inside] = True
            self._arrays()
        if self.raw is None:
            self.raw = self._raw()
        if self.pairs is None:
            self.pairs = np.full(KNOWN_FITS, -1, np.int64)
        if self.automaton is None and self.parts:
            self.automaton = ahocorasick.Automaton()
            for piece in self.parts:
                self.automaton.add_word(piece, (len(piece), self.number[piece]))
            self.automaton.make_automaton()
        return self

    def _arrays(self) -> None:
        """The automaton's words as a tree, and what is known of pairs, for many
        parts at once. The tree's first places are the characters' tokens."""
        size = self.base
        steps: dict[int, int] = {}
        at_node = list(range(size))
        for text in self.parts:
            node = self.number.get(text[0], self.other)
            for c in text[1:]:
                step = node * size + self.number.get(c, self.other)
                node = steps.get(step)
                if node is None:
                    node = steps[step] = len(at_node)
                    at_node.append(-1)
            at_node[node] = self.number[text]
        self.steps = Numbers(list(steps), list(steps.values()))
        self.at_node = np.array(at_node, np.int32)
        self.of_char = np.full(0x110000, self.other, np.int32)
        for text, n in self.number.items():
            if len(text) == 1:
                self.of_char[ord(text)] = n
        self.lengths = np.array(self.length, np.int32)
        self.many_marks = np.array(self.marks) & (self.lengths > 1)
        self.any_marks = np.array(self.marks)
        self.nameless = np.array([not name for name in self.names])
        # ranks in order, twice, so that there is room for one between
        order = {r: 2 * k for k, r in enumerate(sorted({*self.joins.values(), *(r for r in self.rank if r >= 0)}))}
        self.ranks = np.array([order[r] if r >= 0 else -1 for r in self.rank], np.int32)
        self.left_made, self.right_made = np.array(self.made, np.int32).T.copy()
        self.across = Numbers(list(self.joins), [order[r] for r in self.joins.values()])

    def _raw(self) -> pa.Array:
        """The bytes that every id stands for. An id without any has one that is
        never UTF-8, so its row is read id by id."""
        own = [b"\xff"] * self.count
        own[self.unknown] = UNKNOWN.encode()
        for i, text in self.surface.items():
            own[i] = text.encode()
        for i, byte in self.byte_of.items():
            own[i] = bytes([byte])
        return pa.array(own, pa.large_binary())

    def forget(self) -> None:
        """Empties all tables of what has been met."""
        self.pairs = None
        self.fits: dict[int, bool] = {}
        self.fits_before: dict[int, bool] = {}
        self.known = Generations(KNOWN_BYTES)

    def merged(self, text: str, until: int = 1) -> list[str]:
        """Plain merging of a short text: the best-scored adjacent pair that is
        a piece, the leftmost of equals, again and again down to `until` parts."""
        parts = list(text)
        while len(parts) > until:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = self.score.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if until == 2 and len(parts) == 2 and parts[0] + parts[1] not in self.score:
            return list(text)
        return parts

    def compatible(self, left: str, right: str) -> bool:
        """Whether merging the text of both gives both again."""
        return self._compatible(self.number.get(left, self.other), self.number.get(right, self.other))

    def _compatible(self, left: int, right: int) -> bool:
        """The merges that made the two tokens are undone, the latest first; the
        tokens part if a merge across their border would have come earlier."""
        if self.marks[left] or self.marks[right]:  # equal scores
            if self.other in (left, right):
                return True
            return self.merged(self.piece[left] + self.piece[right]) == [self.piece[left], self.piece[right]]
        joins, rank, made, base, border = self.joins, self.rank, self.made, self.base, float("inf")
        while True:
            across = joins.get(left * base + right)
            if across is not None and across < border:
                return False
            late_left, late_right = rank[left], rank[right]
            if late_left < 0 and late_right < 0:
                return True
            if late_left > late_right:
                border, left = late_left, made[left][1]
            else:  # a merge further left comes first among equals
                border, right = late_right + 0.5, made[right][0]

    def _fit(self, pair: int) -> bool:
        """A pair that the present generation does not have."""
        fit = self.fits_before.get(pair)
        if fit is None:
            fit = self._compatible(*divmod(pair, self.base))
        if len(self.fits) >= KNOWN_PAIRS:
            self.fits_before = self.fits.copy()
            self.fits.clear()
        self.fits[pair] = fit
        return fit

    def tokens(self, text: str) -> list[int]:
        """Numbers of the tokens of a run, by the table of last tokens."""
        number, other, base, known = self.number, self.other, self.base, self.fits
        last: list[int] = []  # the last token of every prefix so far
        done = 0
        for end, (size, token) in self.automaton.iter(text) if self.automaton is not None else ():
            if done > end:
                continue
            while done < end:  # no longer token ends there: the character itself does
                last.append(number.get(text[done], other))
                done += 1
            if size <= end:
                pair = last[end - size] * base + token
                fit = known.get(pair)
                if not (self._fit(pair) if fit is None else fit):
                    continue
            last.append(token)
            done += 1
        while done < len(text):
            last.append(number.get(text[done], other))
            done += 1
        found, length, at = [], self.length, len(text)
        while at > 0:
            token = last[at - 1]
            found.append(token)
            at -= length[token]
        found.reverse()
        return found

    def all_fit(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Of many pairs of tokens at once whether they are compatible."""
        key = left.astype(np.int64) * self.base + right
        at = spread(key, KNOWN_FITS.bit_length() - 1)
        known = self.pairs[at]
        fit = (known & 1).astype(bool)
        new = np.flatnonzero(known >> 1 != key)
        if len(new):
            fit[new] = self._all_compatible(left[new], right[new])
            self.pairs[at[new]] = key[new] * 2 + fit[new]
        return fit

    def _all_compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """As _compatible, step by step for all that are undecided."""
        fit = np.ones(len(left), bool)
        marked = self.many_marks[left] | self.any_marks[right]
        for k in np.flatnonzero(marked).tolist():
            fit[k] = self._compatible(int(left[k]), int(right[k]))
        rest = np.flatnonzero(~marked)
        left, right, border = left[rest], right[rest], np.full(len(rest), NEVER, np.int32)
        while len(rest):
            across = self.across.get(left.astype(np.int64) * self.base + right)
            parted = (across >= 0) & (across < border)
            fit[rest[parted]] = False
            late_left, late_right = self.ranks[left], self.ranks[right]
            on = np.flatnonzero(~parted & ((late_left >= 0) | (late_right >= 0)))
            rest, left, right, late_left, late_right = (x[on] for x in (rest, left, right, late_left, late_right))
            first = late_left > late_right
            border = np.where(first, late_left, late_right + 1)
            left, right = np.where(first, self.right_made[left], left), np.where(first, right, self.left_made[right])
        return fit

    def cut(self, text: str, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters of runs, of which the ends are given, and the borders of
        parts. Pairs that share a place are taken for one another; that leaves a
        part longer, not wrong."""
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        border = np.zeros(len(code) + 1, bool)
        wide = code.astype(np.int64)
        border[1:-1] = ~self.beside[place(wide[:-1], wide[1:])]
        border[ends] = border[0] = True
        return code, np.flatnonzero(border)

    def rows(self, text: str, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the tokens of runs, and the place after each token."""
        code, at = self.cut(text, ends)
        places, tokens, k = [], [], 0
        while k < len(at) - 1:  # parts with TOGETHER characters, or one that has more
            to = max(k + 1, int(np.searchsorted(at, at[k] + TOGETHER, "right")) - 1)
            found, made = self._filled(text, code, at[k : to + 1])
            places.append(found)
            tokens.append(made)
            k = to
        return np.concatenate(places or [at[:0]]), np.concatenate(tokens or [self.lengths[:0]])

    def _filled(self, text: str, code: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the parts between the given borders, by the tables of last tokens:
        for each place the words that end there, of which one fits."""
        base, origin, size = self.base, int(at[0]), np.diff(at)
        last = self.of_char[code[at[0] : at[-1]]]  # of the prefix up to every place
        char = last.copy()
        begin, stop = np.repeat(at[:-1] - origin, size), np.repeat(at[1:] - origin, size)
        if len(size) and size.max() > SHORT:
            place_of = np.flatnonzero(np.repeat(size <= SHORT, size))
        else:
            place_of = np.arange(len(last))
        # words of the tree, by length
        end, long, token = [], [], []
        node, n = last[place_of], 1
        while len(place_of):
            more = np.flatnonzero(place_of + n < stop[place_of])
            place_of, node = place_of[more], node[more]
            node = self.steps.get(node.astype(np.int64) * base + char[place_of + n])
            on = np.flatnonzero(node >= 0)
            place_of, node = place_of[on], node[on]
            n += 1
            here = self.at_node[node]
            word = np.flatnonzero(here >= 0)
            end.append(place_of[word] + (n - 1))
            long.append(np.full(len(word), n, np.int32))
            token.append(here[word])
        if end:  # by their last place within the part, then by length
            end, long, token = map(np.concatenate, (end, long, token))
            within = (end - begin[end]).astype(np.uint8)
            order = np.argsort(within, kind="stable")
            end, long, token = end[order], long[order], token[order]
            step = np.cumsum(np.bincount(within, minlength=1)).tolist()
            for k, (a, b) in enumerate(zip(step, step[1:]), 1):
                e, s, t = end[a:b], long[a:b], token[a:b]
                fit = s == k + 1  # from the part's first place on
                inside = np.flatnonzero(~fit)
                fit[inside] = self.all_fit(last[e[inside] - s[inside]], t[inside])
                last[e[fit]] = t[fit]
        # read backwards
        final = np.zeros(len(last), bool)
        back = at[1:][size <= SHORT] - origin - 1
        while len(back):
            final[back] = True
            before = back - self.lengths[last[back]]
            back = before[before >= begin[back]]
        alone: dict[str, np.ndarray] = {}
        for k in np.flatnonzero(size > SHORT).tolist():
            part = text[at[k] : at[k + 1]]
            made = alone.get(part)
            if made is None:
                made = alone[part] = np.array(self.tokens(part), np.int32)
            where = at[k] - origin + np.cumsum(self.lengths[made]) - 1
            last[where], final[where] = made, True
        found = np.flatnonzero(final)
        return found + origin + 1, last[found]

    def bytes_for(self, found: list[int], text: str, places: np.ndarray) -> list[int]:
        """Ids of tokens, with those of its bytes for a character that is no piece."""
        out = []
        for token, after in zip(found, places.tolist()):
            if self.names[token]:
                out.append(token)
            else:
                out.extend(self.byte_ids[b] for b in text[after - 1].encode())
        return out

    def learn(self, found: list[str]) -> dict[str, str]:
        """Decimal ids of all the given runs, which are without their first
        space mark, and of others."""
        known = self.known
        self._learn([run for run in found if run not in known.ids and known.recall(run) is None])
        return known.ids

    def _learn(self, found: list[str]) -> None:
        if not found:
            return
        text = MARK + MARK.join(found)
        ends = np.cumsum([1 + len(run) for run in found])
        places, tokens = self.rows(text, ends)
        names = list(map(self.names.__getitem__, tokens.tolist()))
        first = np.searchsorted(places, ends, "right").tolist()
        odd = np.zeros(len(found), bool)
        odd[np.searchsorted(ends, places[self.nameless[tokens]])] = True
        a, put = 0, self.known.put
        for run, b, other in zip(found, first, odd.tolist()):
            if other:  # some characters are no pieces
                put(run, ",".join(map(str, self.bytes_for(tokens[a:b].tolist(), text, places[a:b]))))
            else:
                put(run, ",".join(names[a:b]))
            a = b

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        found = runs(text)
        text = MARK + MARK.join(found)
        places, tokens = self.rows(text, np.cumsum([1 + len(run) for run in found]))
        return self.bytes_for(tokens.tolist(), text, places)

    def decode(self, ids: list[int]) -> str:
        """Text of ids: the space in front is dropped, bytes are read as UTF-8
        and each byte that does not fit becomes U+FFFD."""
        return dropped(self.plain(ids))

    def decode_all(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """As decode, of many rows of ids, of which the ends are given."""
        if not len(ids):
            return [""] * len(ends)
        _, offsets, data = self.raw.take(pa.array(ids)).buffers()
        places, data = np.frombuffer(offsets, np.int64), memoryview(data)
        out, a = [], 0
        for b in ends.tolist():
            try:  # bytes that are UTF-8 as a whole are so between pieces
                out.append(dropped(str(data[places[a] : places[b]], "utf-8")))
            except UnicodeDecodeError:
                out.append(self.decode(ids[a:b].tolist()))
            a = b
        return out

    def plain(self, ids: list[int]) -> str:
        out, pending = [], bytearray()
        for i in ids:
            byte = self.byte_of.get(i)
            if byte is not None:
                pending.append(byte)
                continue
            if pending:
                out.append(readable(bytes(pending)))
                pending = bytearray()
            out.append(self.surface.get(i, UNKNOWN if i == self.unknown else ""))
        if pending:
            out.append(readable(bytes(pending)))
        return "".join(out)


def readable(raw: bytes) -> str:
    try:
        return raw.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(raw):
            for size in (1, 2, 3, 4):
                try:
                    out.append(raw[at : at + size].decode())
                    at += size
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


def dropped(text: str) -> str:
    return text[1:] if text[:1] == " " else text


def runs(text: str | None) -> list[str]:
    """The text with the space mark in front and for spaces, cut into runs, each
    without its first space mark."""
    if not text:
        return []
    found = text.split(" ")
    if "" in found or MARK in text:  # runs of several marks
        found = [r[1:] for r in RUN.findall(MARK + text.replace(" ", MARK))]
    return found


def _encoder(shared, text_col: str, keep: list[str], with_ids: bool):
    def run(batches):
        pieces = shared.value.ready()
        try:
            yield from coded(pieces, batches)
        finally:  # a worker that waits for its next task holds no tables
            pieces.forget()
            W.give_back()

    def coded(pieces, batches):
        for batch in W.slices(batches, text_col, SLICE_BYTES):
            texts = batch.column(text_col).to_pylist()
            all_runs = [runs(text) for text in texts]
            pieces.known.turn()
            known = pieces.learn(list(dict.fromkeys([r for found in all_runs for r in found])))
            sizes, digests, all_ids = [], [], []
            for found in all_runs:
                joined = ",".join([known[r] for r in found])
                sizes.append(joined.count(",") + 1 if joined else 0)
                digests.append(hashlib.sha256(joined.encode()).hexdigest())
                all_ids.append(np.fromstring(joined, np.int32, sep=","))
            ids, ends = np.concatenate(all_ids), np.cumsum(sizes)
            decoded = [hashlib.sha256(plain.encode()).hexdigest() for plain in pieces.decode_all(ids, ends)]
            made = [pa.array(sizes, pa.int64())]
            names = ["n_tokens"]
            if with_ids:
                starts = np.concatenate([[0], ends]).astype(np.int32)
                made.append(pa.ListArray.from_arrays(pa.array(starts), pa.array(ids)))
                names.append("ids")
            made += [pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
            names += ["ids_sha256", "decoded_sha256"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *made], [*keep, *names])

    return run


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, model_path: str, text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """`docs` with n_tokens, ids (if asked for), ids_sha256 (of the decimal ids
    joined by commas) and decoded_sha256 (of the text that the ids decode to).

    The model file, some hundred kilobytes, is read by the driver and sent to
    the tasks. Null and empty texts have no ids. Every row is encoded whole,
    repeated rows each on their own; an empty table gives an empty result;
    columns with the names of the new ones are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Pieces(read_model(model_path)))
    keep = [c for c in docs.columns if c not in COLUMNS]
    fields = [docs.schema[c] for c in keep] + [T.StructField("n_tokens", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    fields += [T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    rows = docs.select(*keep) if text_col in keep else docs
    return rows.mapInArrow(_encoder(shared, text_col, keep, with_ids), T.StructType(fields))


def decode(rows: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """`rows` with `out_col`, the text of the ids; null ids give an empty text."""
    shared = rows.sparkSession.sparkContext.broadcast(Pieces(read_model(model_path)))
    keep = [c for c in rows.columns if c != out_col]

    def run(batches):
        pieces = shared.value
        for batch in batches:
            texts = [pieces.decode(i.as_py() or []) for i in batch.column(ids_col)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(texts, pa.string())], [*keep, out_col]
            )

    schema = T.StructType([*(rows.schema[c] for c in keep), T.StructField(out_col, T.StringType())])
    return rows.mapInArrow(run, schema)
