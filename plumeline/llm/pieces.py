"""SentencePiece encoding and decoding with the N best segmentations.

The piece lattice of a text has an edge for every vocabulary piece that occurs
in it.  A forward Viterbi pass gives, for every position, the best score of
reaching it; that score is an exact heuristic for an A-star search from the end
back to the start, which meets complete segmentations in order of score.

No piece crosses from a letter into a space mark, so the lattice falls apart
into units (a run of space marks and the letters after it).  Units are searched
one by one, frequent ones once per worker, and the N best of a text are the N
best combinations of its units' alternatives.  Units that a worker meets for the
first time go through the forward pass together, as arrays: all starts of all
units walk the vocabulary's trie side by side, then the positions of all units
are settled in order of their distance from the unit's start.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heappop, heappush, nsmallest
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
N_BEST = 4
MARK = "▁"
# Units up to this long are remembered, up to twice this many per worker.
_CACHED_CHARS = 48
_CACHED_UNITS = 500_000
# Texts are looked at together until they have this many characters, new units in so many at once.
_CHUNK_CHARS = 1 << 20
_TOGETHER = 50_000
# Scores that are not whole numbers are kept as whole multiples of one over this.
SCALE = 1_000_000
_UNITS = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")

_NONE, _UNRANKED = -(1 << 60), -(10 ** 8)

Path = tuple[int, tuple[int, ...]]  # score, piece ids
# Best score, loss of the second best (None: no other path), pieces, ids as text, decoded text.
Unit = tuple[int, int | None, int, str, str]


class Vocabulary:
    """Pieces with integer scores, byte pieces for what has no piece."""

    def __init__(self, pieces: list[tuple[str, int, int]], byte_ids: dict[int, int], scale: int = 1) -> None:
        """``pieces``: (piece, id, score times ``scale``) of the ordinary ones."""
        self.byte_ids, self.scale = byte_ids, scale
        self.raw = {i: p.replace(MARK, " ").encode() for p, i, _ in pieces}
        self.raw |= {i: bytes([b]) for b, i in byte_ids.items()}
        # Worse than any piece, as is usual for what the vocabulary does not know.
        self.byte_score = min((s for _, _, s in pieces if s > _UNRANKED * scale), default=0) - 10 * scale
        if any("\n" in p or MARK in p.lstrip(MARK) for p, _, _ in pieces):
            raise ValueError("a piece crosses a unit boundary")
        # Every beginning of a piece, with the piece's score and id where it is one.
        self.known: dict[str, tuple[int, int] | None] = {}
        for p, i, score in pieces:
            for k in range(1, len(p)):
                self.known.setdefault(p[:k], None)
            self.known[p] = (score, i)
        self._plant()
        self.young: dict[str, Unit] = {}
        self.old: dict[str, Unit] = {}

    def _plant(self) -> None:
        """The trie of ``known`` as arrays: sorted (node, character) keys and what they lead to."""
        at = {"": 0} | {p: k for k, p in enumerate(self.known, 1)}
        keys = np.array([at[p[:-1]] << 21 | ord(p[-1]) for p in self.known], np.int64)
        order = np.argsort(keys)
        self.keys, self.child = keys[order], order + 1
        self.piece_score = np.array([0] + [v[0] if v else 0 for v in self.known.values()], np.int64)
        self.piece_id = np.array([-1] + [v[1] if v else -1 for v in self.known.values()], np.int64)
        self.id_text = {i: str(i) for i in self.raw}

    def _bytes_of(self, char: str) -> tuple[int, ...]:
        return tuple(self.byte_ids[b] for b in char.encode("utf-8", "surrogatepass"))

    def edges(self, unit: str) -> list[list[tuple[int, int, tuple[int, ...]]]]:
        """Per end position the edges (start, score, ids) that end there."""
        out: list[list] = [[] for _ in range(len(unit) + 1)]
        get, n = self.known.get, len(unit)
        for start in range(n):
            end, found = start + 1, get(unit[start], 0)
            if not found:
                ids = self._bytes_of(unit[start])
                out[end].append((start, len(ids) * self.byte_score, ids))
            while found != 0:
                if found:
                    out[end].append((start, found[0], (found[1],)))
                if end == n:
                    break
                end += 1
                found = get(unit[start:end], 0)
        return out

    def viterbi(self, unit: str) -> tuple[int, int | None, tuple[int, ...]]:
        """Best score, second-best score (None: there is one path only) and best ids."""
        get, n = self.known.get, len(unit)
        best, second = [_NONE] * (n + 1), [_NONE] * (n + 1)
        back: list = [None] * (n + 1)
        best[0] = 0
        ends = range(1, n + 1)
        for start in range(n):
            here = best[start]
            for end in ends[start:]:
                found = get(unit[start:end], 0)
                if found:
                    more, own = found
                elif end == start + 1:
                    own = self._bytes_of(unit[start])
                    more = len(own) * self.byte_score
                elif found is None:
                    continue
                else:
                    break
                score = here + more
                if score > best[end]:
                    # What was best is now second, unless this edge's own second beats it.
                    other = second[start] + more
                    second[end] = best[end] if best[end] > other else other
                    best[end] = score
                    back[end] = (start, own)
                elif score > second[end]:
                    second[end] = score
                if found == 0:
                    break
        ids: list = []
        at = n
        while at:
            at, own = back[at]
            if isinstance(own, int):
                ids.append(own)
            else:
                ids += own[::-1]
        return best[n], None if second[n] <= _NONE // 2 else second[n], tuple(ids[::-1])

    def viterbi_all(self, units: list[str]) -> list[Unit | None]:
        """The same for many units at once; None where a character has no piece of its own."""
        size = np.fromiter(map(len, units), np.int64, len(units))
        of = np.repeat(np.arange(len(units)), size)  # a character's unit
        first = np.cumsum(size) - size
        codes = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        ends, starts = (first + size)[of], first[of]
        at, node, depth = np.arange(len(codes)), np.zeros(len(codes), np.int64), 0
        spelled = np.zeros(len(units), bool)
        found = []
        while at.size:
            key = node << 21 | codes[at + depth]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[place] == key
            if not depth:
                spelled[of[at[~hit]]] = True
            at, node, depth = at[hit], self.child[place[hit]], depth + 1
            piece = self.piece_id[node] >= 0
            if depth == 1:
                spelled[of[at[~piece]]] = True
            found.append((at[piece], at[piece] + depth, node[piece]))
            on = at + depth < ends[at]
            at, node = at[on], node[on]
        start, end, node = (np.concatenate(c) for c in zip(*found))
        distance = start - starts[start]
        order = np.argsort(distance, kind="stable")
        start, end, node, distance = start[order], end[order], node[order], distance[order]
        # Every unit has one place more than characters: the one in front of its first.
        unit = of[start]
        start, end = start + unit, end + unit
        more, own = self.piece_score[node], self.piece_id[node]
        origin = first + np.arange(len(units))
        best = np.full(len(codes) + len(units), _NONE, np.int64)
        second, back, taken = best.copy(), np.zeros_like(best), np.zeros_like(best)
        best[origin] = 0
        cuts = np.searchsorted(distance, np.arange(size.max() + 1))
        for a, b in zip(cuts[:-1], cuts[1:]):  # within a slice no two edges end at one place
            s, e, m = start[a:b], end[a:b], more[a:b]
            score, was = best[s] + m, best[e]
            better = score > was
            second[e] = np.where(better, np.maximum(was, second[s] + m), np.maximum(second[e], score))
            best[e] = np.maximum(score, was)
            back[e[better]], taken[e[better]] = s[better], own[a:b][better]
        last = origin + size
        on_path = np.zeros(len(best), bool)
        at = last[~spelled]
        inside = np.ones(len(best), bool)
        inside[origin] = False
        while at.size:
            on_path[at] = True
            at = back[at]
            at = at[inside[at]]
        ids = taken[on_path].tolist()
        upto = np.cumsum(on_path)[last].tolist()
        texts, raws = [self.id_text[i] for i in ids], [self.raw[i] for i in ids]
        out: list[Unit | None] = []
        a = 0
        for b, skip, top, next_best in zip(upto, spelled.tolist(), best[last].tolist(), second[last].tolist()):
            out.append(None if skip else (
                top, None if next_best <= _NONE // 2 else top - next_best, b - a, ",".join(texts[a:b]),
                b"".join(raws[a:b]).decode("utf-8", "surrogatepass")))
            a = b
        return out

    def n_best(self, unit: str, n: int) -> list[Path]:
        """The n best segmentations of a unit, best first.

        Equal scores leave in the order in which the search meets them, which
        depends on the unit alone.
        """
        edges = self.edges(unit)
        reach = [0] * (len(unit) + 1)
        for end in range(1, len(unit) + 1):
            reach[end] = max([reach[s] + score for s, score, _ in edges[end]])
        found: list[Path] = []
        # Entries: -(best total), position, order, score so far, chain of ids behind.
        agenda, order = [(-reach[-1], len(unit), 0, 0, None)], 1
        while agenda and len(found) < n:
            _, at, _, score, chain = heappop(agenda)
            if not at:
                ids: list[int] = []
                while chain:
                    ids += chain[0]
                    chain = chain[1]
                found.append((score, tuple(ids)))
                continue
            for start, more, own in edges[at]:
                total = score + more
                heappush(agenda, (-(reach[start] + total), start, order, total, (own, chain)))
                order += 1
        return found

    def unit(self, text: str | None) -> Unit:
        """What a text needs of a unit; remembered in two generations of bounded size."""
        if text is None:  # a mark that stands in the text itself is spelled in bytes
            ids = self._bytes_of(MARK)
            return len(ids) * self.byte_score, None, len(ids), ",".join(map(str, ids)), MARK
        found = self.old.get(text)
        if found is None:
            score, second, ids = self.viterbi(text)
            raw = b"".join([self.raw[i] for i in ids]).decode("utf-8", "surrogatepass")
            found = (score, None if second is None else score - second, len(ids), ",".join(map(str, ids)), raw)
        if len(text) <= _CACHED_CHARS:
            self._remember(text, found)
        return found

    def _remember(self, text: str, found: Unit) -> None:
        if len(self.young) >= _CACHED_UNITS:
            self.old, self.young = self.young, {}
        self.young[text] = found

    def learn(self, listed: list[list[str | None]]) -> None:
        """Put the new units of some texts through one forward pass; long and spelled ones wait for ``unit``."""
        new = set().union(*listed) - self.young.keys() - self.old.keys()
        names = [u for u in new if u is not None and len(u) <= _CACHED_CHARS]
        for k in range(0, len(names), _TOGETHER):
            part = names[k:k + _TOGETHER]
            for name, found in zip(part, self.viterbi_all(part)):
                if found is not None:
                    self._remember(name, found)

    def split(self, texts: Iterable[str]) -> Iterator[tuple[str, list[str | None]]]:
        """Texts with their units, which are learned a chunk at a time."""
        for chunk in in_chunks(texts):
            listed = [units_of(t) for t in chunk]
            self.learn(listed)
            yield from zip(chunk, listed)

    def lattice(self, names: list[str | None]) -> list[Unit]:
        get, unit = self.young.get, self.unit
        return [get(u) or unit(u) for u in names]

    def choices(self, names: list[str | None], units: list[Unit], n: int) -> list[tuple[int, dict[int, Path]]]:
        """The n best of a text: (score, {unit number: its other path}).

        They differ from the best in the n - 1 places that cost least only, so
        the A-star search runs on those and their combinations are enough.
        """
        best = sum([u[0] for u in units])
        places = nsmallest(n - 1, [(u[1], i) for i, u in enumerate(units) if u[1] is not None])
        paths = [self.n_best(names[i], n) for _, i in places]
        options = []
        for choice in product(*[range(len(p)) for p in paths]):
            loss = sum(p[0][0] - p[c][0] for p, c in zip(paths, choice))
            options.append((loss, choice))
        return [(best - loss, {i: p[c] for (_, i), p, c in zip(places, paths, choice) if c})
                for loss, choice in nsmallest(n, options)]

    def encode(self, text: str, n: int = N_BEST) -> list[Path]:
        """The n best segmentations of a text; an empty text has the empty one."""
        names = units_of(text)
        units = self.lattice(names)
        out = []
        for score, taken in self.choices(names, units, n):
            ids: list[int] = []
            for i, u in enumerate(units):
                ids += taken[i][1] if i in taken else map(int, u[3].split(","))
            out.append((score, tuple(ids)))
        return out

    def decode(self, ids: Iterator[int]) -> str:
        """The text of piece ids: byte pieces are joined, marks are spaces, the first one goes."""
        return b"".join([self.raw[i] for i in ids]).decode("utf-8", "surrogatepass")[1:]


def units_of(text: str) -> list[str | None]:
    """Units of a text, spaces as marks and one mark in front; None is a mark of the text's own."""
    if not text:
        return []
    if MARK not in text:
        return _UNITS.findall(MARK + text.replace(" ", MARK))
    out: list[str | None] = []
    for k, part in enumerate(text.split(MARK)):
        out += [None] * (k > 0)
        out += _UNITS.findall(MARK * (k == 0) + part.replace(" ", MARK))
    return out


@lru_cache(maxsize=4)
def vocabulary(model: str) -> Vocabulary:
    """The pieces of a SentencePiece model file, read once per worker."""
    import sentencepiece

    model_file = sentencepiece.SentencePieceProcessor(model_file=model)
    pieces, byte_ids = [], {}
    scores = [model_file.get_score(i) for i in range(model_file.vocab_size())]
    scale = 1 if all(s == round(s) for s in scores) else SCALE
    for i in range(model_file.vocab_size()):
        piece = model_file.id_to_piece(i)
        if model_file.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
        elif not (model_file.is_control(i) or model_file.is_unknown(i) or model_file.is_unused(i)):
            pieces.append((piece, i, round(scores[i] * scale)))
    return Vocabulary(pieces, byte_ids, scale)


def in_chunks(texts: Iterable[str]) -> Iterator[list[str]]:
    """Texts in order, cut into lists of about a million characters; a longer text is alone or last."""
    chunk, held = [], 0
    for text in texts:
        chunk.append(text)
        held += len(text)
        if held >= _CHUNK_CHARS:
            yield chunk
            chunk, held = [], 0
    if chunk:
        yield chunk


def segment(df: DataFrame, keep: dict[str, Column], *, text: str = "text", model: str = MODEL,
            n: int = N_BEST, with_ids: bool = False) -> DataFrame:
    """``keep`` plus piece counts, digests, the N best scores and the round trip.

    ``n_pieces, ids_sha256``: the best segmentation; ``n_best``: how many there
    are, up to n; ``scores``: theirs, comma-joined; ``n_best_sha256``: digest of
    the best and of where the others differ; ``round_trip``: does decoding each
    give the text?  ``ids`` comes
    with ``with_ids``.  A NULL text counts as empty, whose one segmentation is
    empty; repeated rows are encoded each, equal scores keep the earlier start,
    and an empty table gives an empty one.  Scores of a model whose piece scores
    are not whole numbers are multiplied by ``SCALE`` and rounded per piece.
    ``keep`` may use any names, also those of columns of ``df``, but not
    ``_text`` or the names above.  Texts stream through whole; a task holds about
    a million characters of them, or one longer text, besides remembered units.
    """
    rows = df.select(*[c.alias(k) for k, c in keep.items()],
                     F.coalesce(df[text].cast("string"), F.lit("")).alias("_text"))
    extra = ("n_pieces long, ids_sha256 string, n_best int, scores string, n_best_sha256 string, "
             "round_trip boolean")
    schema = rows.drop("_text").schema
    from pyspark.sql.types import StructType
    for field in StructType.fromDDL(extra + (", ids array<int>" if with_ids else "")):
        schema = schema.add(field)
    names = schema.fieldNames()
    kinds = [pa.int64(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.bool_()] + [
        pa.list_(pa.int32())] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(model)
        for batch in batches:
            out = []
            for body, unit_names in known.split(v.as_py() for v in batch.column(batch.num_columns - 1)):
                units = known.lattice(unit_names)
                chosen = known.choices(unit_names, units, n)
                listed = ",".join([u[3] for u in units])
                whole = "".join([u[4] for u in units])[1:] == body
                best = hashlib.sha256(listed.encode())
                every = best.copy()
                for _, taken in chosen[1:]:
                    # Only the units that differ: which, and their other pieces.
                    for i, (_, ids) in sorted(taken.items()):
                        every.update(f"|{i}:{','.join(map(str, ids))}".encode())
                        whole &= b"".join([known.raw[p] for p in ids]).decode("utf-8", "surrogatepass") == units[i][4]
                    every.update(b";")
                row = (sum([u[2] for u in units]), best.hexdigest(), len(chosen),
                       ",".join([str(s) for s, _ in chosen]), every.hexdigest(), whole)
                ids = [int(i) for i in listed.split(",")] if with_ids and listed else []
                out.append(row + ((ids,) if with_ids else ()))
            if out:
                columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=names)

    return rows.mapInArrow(run, schema)
