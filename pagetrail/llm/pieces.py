"""Sampled SentencePiece segmentations by forward filtering and backward sampling; lossless decoding."""

from __future__ import annotations

import itertools
import os
import re
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import prepare
from .words import _BASE, _INVERSE, GROUP, groups, larger, mix, powers

#: Characters whose lattices are made at a time: bounds the memory for that.
CHARS_AT_A_TIME = 1 << 19
#: Arcs of lattices that a worker keeps for the next texts, about 20 bytes each. Beyond that it starts anew.
KEPT_ARCS = 1 << 22
#: Longer units are filtered one by one, shorter ones all at once, place by place.
LONG = 256
#: So few walks are finished one by one.
FEW = 24
#: A piece of rank r has a weight of (r + 2) ** -SHARPNESS: the larger, the closer to the best segmentation.
SHARPNESS = 2.0
SPACE = "▁"  # how the vocabulary writes a space

#: Punctuation, carriage returns with it, as the inside of a character class.
_MARKS = r"\r!-/:-@\[-`{-~\xa1-\xa9\xab-\xb4\xb6-\xb9\xbb-\xbf\u2010-\u2027\u2030-\u205e"
#: Texts fall into units that no piece crosses: a line end, spaces, a run of letters or of punctuation with the spaces
#: before it. A vocabulary with a piece that crosses units is refused when it is loaded.
_UNIT = re.compile(rf"\n| *[^\x00-\x1f 0-9\x7f{_MARKS}]+| *[{_MARKS}]+| *[^ \n]| +")


class Table:
    """64-bit keys to places in sorted order, by the keys' leading bits."""

    BITS = 20

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = np.append(keys, np.uint64(2**64 - 1))
        leading = (keys >> np.uint64(64 - self.BITS)).astype(np.int64)
        self.first = np.searchsorted(leading, np.arange(1 << self.BITS)).astype(np.int32)
        self.most = int(np.bincount(leading).max())

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are there, and their places."""
        at = self.first[keys >> np.uint64(64 - self.BITS)]
        for _ in range(self.most):
            later = np.flatnonzero(self.keys[at] < keys)
            if not len(later):
                break
            at[later] += 1
        return self.keys[at] == keys, at


class Lattices:
    """Lattices of units: for each place, the pieces that end there with their forward probabilities.

    Nodes are the places of all units, one after the other; a node's arcs are the pieces that end in it, with the
    running total of their probabilities. A worker keeps what it has made, as far as KEPT_ARCS goes, so that
    a frequent unit is filtered once. What is kept has no influence on any number.
    """

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(n)]
        ordinary = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        ordinary.sort(key=lambda i: (-model.get_score(i), i))
        weight = {i: (rank + 2.0) ** -SHARPNESS for rank, i in enumerate(ordinary)}
        self.piece: dict[str, tuple[int, float]] = {}
        for i in ordinary:
            text = pieces[i].replace(SPACE, " ")
            if len(_UNIT.findall(text)) != 1:
                raise ValueError(f"the piece {text!r} crosses units: it could never be drawn")
            self.piece[text] = (i, weight[i])
        self.longest = max(map(len, self.piece))
        self.byte = {int(pieces[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        if len(self.byte) < 256:
            raise ValueError("the vocabulary has no piece for every byte")
        self.least = (len(ordinary) + 2.0) ** -SHARPNESS
        content = [b""] * n  # what a piece stands for
        for text, (i, _) in self.piece.items():
            content[i] = text.encode()
        for value, i in self.byte.items():
            content[i] = bytes([value])
        lengths = np.array([len(c) for c in content])
        self.content = np.frombuffer(b"".join(content), np.uint8)
        self.content_start, self.content_length = np.cumsum(lengths) - lengths, lengths
        # the beginnings of pieces: a place is followed only as long as a piece may come of it
        texts = list(dict.fromkeys(t[:k] for t in self.piece for k in range(1, len(t) + 1)))
        edges = np.cumsum([0, *map(len, texts)])
        keys = self._keys(mix(self._codes("".join(texts))), edges[:-1], np.diff(edges))
        order = np.argsort(keys)
        self.table = Table(keys[order])
        known = [self.piece.get(t, (-1, 0.0)) for t in texts]
        self.key_id = np.array([i for i, _ in known], np.int32)[order]
        self.key_weight = np.array([w for _, w in known])[order]
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.first_node = np.zeros(0, np.int64)  # of each unit
        self.last_node = np.zeros(0, np.int64)
        self.first_arc = np.zeros(0, np.int64)  # of each node
        self.upto = np.zeros(0)  # of each arc: the probability of it or one before it; of the last: 2
        self.step = np.zeros(0, np.uint8)  # characters
        self.id = np.zeros(0, np.int32)  # of the piece; -1 - c: the bytes of the character c

    @staticmethod
    def _codes(text: str) -> np.ndarray:
        return np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)

    @staticmethod
    def _sums(values: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * powers(_BASE, len(values)), out=sums[1:])
        return sums

    def _keys(self, values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        sums = self._sums(values)
        inverse = powers(_INVERSE, len(values) + 1)[starts]
        return mix((sums[starts + lengths] - sums[starts]) * inverse + lengths.astype(np.uint64))

    def _learn(self, units: list[str]) -> None:
        """Make the lattices of units that are not known yet."""
        parts = [[self.first_node], [self.last_node], [self.first_arc], [self.upto], [self.step], [self.id]]
        nodes, arcs = len(self.first_arc), len(self.upto)
        some: list[str] = []
        size = 0
        for k, unit in enumerate(units):
            some.append(unit)
            size += len(unit)
            if size < CHARS_AT_A_TIME and k + 1 < len(units):
                continue
            first, last, first_arc, upto, step, ids = self._filter(some)
            for part, more in zip(parts, (first + nodes, last + nodes, first_arc + arcs, upto, step, ids)):
                part.append(more)
            nodes, arcs = nodes + len(first_arc), arcs + len(upto)
            some, size = [], 0
        self.first_node, self.last_node, self.first_arc, self.upto, self.step, self.id = map(np.concatenate, parts)

    def _filter(self, units: list[str]) -> tuple[np.ndarray, ...]:
        """Forward filtering: of each unit its first and last node, of each node its first arc, and the arcs."""
        length = np.array([len(u) for u in units])
        codes = self._codes("".join(units))
        n = len(codes)
        unit = np.repeat(np.arange(len(units)), length)  # of each character; its node is its number and that of its unit
        unit_end = np.cumsum(length)[unit]
        sums, inverse = self._sums(mix(codes)), powers(_INVERSE, n + 1)
        active = np.arange(n)
        found: list[tuple[np.ndarray, int, np.ndarray]] = []
        alone = np.ones(n, bool)
        for k in range(1, self.longest + 1):
            active = active[active + k <= unit_end[active]]
            there, at = self.table.find(mix((sums[active + k] - sums[active]) * inverse[active] + np.uint64(k)))
            active, at = active[there], at[there]
            whole = self.key_id[at] >= 0
            found.append((active[whole], k, at[whole]))
            if k == 1:
                alone[active[whole]] = False
            if not len(active):
                break
        lone = np.flatnonzero(alone)  # a character without a piece becomes its bytes
        code = codes[lone].astype(np.int64)
        n_bytes = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
        start = np.concatenate([lone, *[s for s, _, _ in found]])
        step = np.concatenate([np.ones(len(lone), np.uint8), *[np.full(len(s), k, np.uint8) for s, k, _ in found]])
        weight = np.concatenate([self.least**n_bytes, *[self.key_weight[at] for _, _, at in found]])
        ids = np.concatenate([-1 - code, *[self.key_id[at] for _, _, at in found]]).astype(np.int32)
        node = start + step + unit[start]
        order = np.argsort(node, kind="stable")
        node, step, weight, ids = node[order], step[order], weight[order], ids[order]
        n_nodes = n + len(units)
        first_arc = np.searchsorted(node, np.arange(n_nodes))
        last = np.cumsum(length + 1) - 1
        first = last - length
        share = self._shares(length, first, node, node - step, weight, first_arc)

        nth = np.arange(len(node)) - first_arc[node]
        by_nth = np.argsort(nth, kind="stable")
        edges = np.searchsorted(nth[by_nth], np.arange(int(nth.max(initial=0)) + 2))
        for k in range(1, len(edges) - 1):
            at = by_nth[edges[k] : edges[k + 1]]
            share[at] += share[at - 1]
        share[np.append(node[1:] != node[:-1], True)[: len(node)]] = 2.0
        return first, last, first_arc, share, step, ids

    def _shares(self, length, first, node, origin, weight, first_arc) -> np.ndarray:
        """The probability of each arc among those that end in its node, over all ways to get there."""
        share = np.empty(len(node))
        reach = np.zeros(len(first_arc))
        reach[first] = 1.0
        unit = np.searchsorted(first, node, "right") - 1
        place = node - first[unit]
        short = np.flatnonzero(length[unit] <= LONG)
        by_place = short[np.argsort(place[short], kind="stable")]
        top = int(place[by_place[-1]]) if len(by_place) else 0
        edges = np.searchsorted(place[by_place], np.arange(top + 2))
        for p in range(1, top + 1):
            at = by_place[edges[p] : edges[p + 1]]
            ways = weight[at] * reach[origin[at]]
            begin = np.flatnonzero(np.append(True, node[at[1:]] != node[at[:-1]]))
            total = np.add.reduceat(ways, begin)
            ends = node[at[begin]]
            reach[ends] = total
            share[at] = ways / np.repeat(total, np.diff(np.append(begin, len(at))))
            low = ends[total < 1e-200]  # only ratios count: scale what later places can see
            for k in range(min(p, self.longest) + 1) if len(low) else ():
                reach[low - k] *= 1e150
        for u in np.flatnonzero(length > LONG).tolist():
            low, high = first_arc[first[u]], first_arc[first[u] + length[u]]
            high = len(node) if first[u] + length[u] + 1 == len(first_arc) else first_arc[first[u] + length[u] + 1]
            share[low:high] = _long_shares(
                (node[low:high] - first[u]).tolist(), (origin[low:high] - first[u]).tolist(), weight[low:high].tolist(), self.longest
            )
        return share

    def sample(self, texts: list[str], seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward sampling of all units at once, from their last place; random numbers are hashes of a
        text's seed, the unit's number in the text and the place. Ids, and the edges between the texts."""
        if len(self.upto) > KEPT_ARCS:
            self._forget()
        cut = [_UNIT.findall(" " + t) if t else [] for t in texts]  # as the vocabulary wants it, texts begin with a space
        per_text = np.array([len(units) for units in cut], np.int64)
        if not per_text.sum():
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        flat = list(chain.from_iterable(cut))
        new = [u for u in dict.fromkeys(flat) if u not in self.known]
        if new:
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self._learn(new)
        number = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
        text_of = np.repeat(np.arange(len(texts)), per_text)
        nth = np.arange(len(number)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        seed = mix(seeds[text_of] ^ mix(nth.astype(np.uint64) + np.uint64(1)))
        active, node, stop = np.arange(len(number)), self.last_node[number], self.first_node[number]
        taken: list[tuple[np.ndarray, np.ndarray]] = []
        while len(active) > FEW:
            u = (mix(seed[active] + np.uint64(len(taken) + 1)) >> np.uint64(11)).astype(np.float64) * 2.0**-53
            arc = self.first_arc[node]
            later = np.flatnonzero(self.upto[arc] <= u)
            while len(later):
                arc[later] += 1
                later = later[self.upto[arc[later]] <= u[later]]
            taken.append((active, arc))
            node = node - self.step[arc]
            going = node > stop
            active, node, stop = active[going], node[going], stop[going]
        # arcs were taken from the last to the first of a unit
        rest = [self._walk(int(seed[i]), a, b, len(taken)) for i, a, b in zip(active.tolist(), node.tolist(), stop.tolist())]
        per_unit = np.bincount(np.concatenate([a for a, _ in taken] or [active]), minlength=len(number)) * bool(taken)
        per_unit[active] += np.array([len(r) for r in rest], np.int64)
        after = np.cumsum(per_unit)
        unit, arc = np.repeat(np.arange(len(number)), per_unit), np.empty(after[-1], np.int64)
        for k, (some, arcs) in enumerate(taken):
            arc[after[some] - 1 - k] = arcs
        for i, walk in zip(active.tolist(), rest):
            low = after[i] - per_unit[i]
            arc[low : low + len(walk)] = walk[::-1]
        found, text = self.id[arc], text_of[unit]
        lone = np.flatnonzero(found < 0)
        raw = [chr(-1 - c).encode() for c in found[lone].tolist()]
        lengths = np.ones(len(found), np.int64)
        lengths[lone] = [len(r) for r in raw]
        ids = np.repeat(found, lengths)
        for at, r in zip((np.cumsum(lengths) - lengths)[lone].tolist(), raw):
            ids[at : at + len(r)] = [self.byte[b] for b in r]
        per = np.bincount(text, weights=lengths, minlength=len(texts)).astype(np.int64)
        return ids, np.concatenate([[0], np.cumsum(per)])

    def _walk(self, seed: int, node: int, stop: int, step: int) -> list[int]:
        """The arcs of one unit from a node down to its first: what ``sample`` does for all, for few long ones."""
        low = int(self.first_arc[stop])
        high = int(self.first_arc[node + 1]) if node + 1 < len(self.first_arc) else len(self.upto)
        upto, steps = self.upto[low:high].tolist(), self.step[low:high].tolist()
        first = (self.first_arc[stop : node + 1] - low).tolist()
        turns = np.arange(step + 1, step + 2 + node - stop, dtype=np.uint64)
        draws = ((mix(np.uint64(seed) + turns) >> np.uint64(11)).astype(np.float64) * 2.0**-53).tolist()
        arcs = []
        place = node - stop
        for u in draws:
            if not place:
                break
            arc = first[place]
            while upto[arc] <= u:
                arc += 1
            arcs.append(arc + low)
            place -= steps[arc]
        return arcs

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of any segmentation: pieces' contents without the space that every text begins with."""
        lengths = self.content_length[ids]
        source = np.arange(lengths.sum()) + np.repeat(self.content_start[ids] - (np.cumsum(lengths) - lengths), lengths)
        return self.content[source].tobytes()[1:]


def _long_shares(node: list[int], origin: list[int], weight: list[float], longest: int) -> list[float]:
    """``Lattices._shares`` of one long unit, whose places depend on each other one by one."""
    reach = [1.0] + [0.0] * node[-1]
    share: list[float] = []
    at = 0
    while at < len(node):
        here, end = node[at], at
        while end < len(node) and node[end] == here:
            end += 1
        ways = [weight[k] * reach[origin[k]] for k in range(at, end)]
        total = sum(ways)
        reach[here] = total
        share += [w / total for w in ways]
        if total < 1e-200:
            for k in range(max(0, here - longest), here + 1):
                reach[k] *= 1e150
        at = end
    return share


_loaded: dict[str, Lattices] = {}


def _lattices(path: str) -> Lattices:
    if path not in _loaded:
        os.environ["OMP_NUM_THREADS"] = "1"
        _loaded[path] = Lattices(path)
    return _loaded[path]


def _drawn(
    rows: DataFrame, model: str, row_id: str, text: str, seed: int, columns: Callable[[Lattices, np.ndarray, np.ndarray], list], schema: str
) -> DataFrame:
    """(id and ``schema``): what ``columns`` makes of the ids of several texts and the edges between them."""
    prepare(rows.sparkSession)
    key = F.xxhash64(F.lit(seed), F.coalesce(F.col(row_id).cast("string"), F.lit("0")))
    given = rows.select(F.col(row_id).alias("id"), key.alias("key"), F.col(text).alias("text"))
    schema = f"id {given.schema['id'].dataType.simpleString()}, {schema}"
    names = [field.split()[0] for field in schema.split(", ")]

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices = _lattices(model)
        for batch in larger(batches):
            keys = batch.column(1).to_numpy().view(np.uint64)
            for first, texts in groups(batch, "text"):
                ids, edges = lattices.sample([t.decode() for t in texts], mix(keys[first : first + len(texts)].copy()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), *columns(lattices, ids, edges)], names)

    return given.mapInArrow(compute, schema)


def encode(rows: DataFrame, model: str, row_id: str = "doc_id", text: str = "text", seed: int = 0) -> DataFrame:
    """(id, ids): a segmentation of each text, drawn with the probability of its pieces.

    The draw depends on the seed, the row's id and the text only, so it is the same however rows are spread or
    repeated. Characters without a piece become bytes. A null or empty text has no ids; rows without an
    id draw as id 0. An empty table stays empty. Other columns are not read. ``model`` is a file that every executor finds.
    """

    def lists(lattices: Lattices, ids: np.ndarray, edges: np.ndarray) -> list:
        return [pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(ids))]

    return _drawn(rows, model, row_id, text, seed, lists, "ids array<int>")


def decode(rows: DataFrame, model: str) -> DataFrame:
    """(id, ids) to (id, text). Null ids: null text."""
    prepare(rows.sparkSession)
    kind = rows.schema["id"].dataType.simpleString()

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices = _lattices(model)
        for batch in batches:
            texts = [lattices.decode(v.values.to_numpy()) if v.is_valid else None for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()).cast(pa.string())], ["id", "text"])

    return rows.select("id", "ids").mapInArrow(compute, f"id {kind}, text string")


def digests(rows: DataFrame, model: str, row_id: str = "doc_id", text: str = "text", seed: int = 0) -> DataFrame:
    """(id, n_ids, ids_crc32, text): of the segmentation that ``encode`` draws, the number of ids, their unsigned CRC
    as little-endian 32-bit numbers, and the text that they decode to; a null text decodes to an empty one. The ids
    stay in the task that draws them."""

    def summed(lattices: Lattices, ids: np.ndarray, edges: np.ndarray) -> list:
        parts = [ids[a:b] for a, b in itertools.pairwise(edges.tolist())]
        crc = [zlib.crc32(part.astype("<u4").tobytes()) for part in parts]
        texts = pa.array([lattices.decode(part) for part in parts], pa.binary()).cast(pa.string())
        return [pa.array(np.diff(edges), pa.int64()), pa.array(crc, pa.int64()), texts]

    return _drawn(rows, model, row_id, text, seed, summed, "n_ids long, ids_crc32 long, text string")


def op4_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's number of ids, their CRC, and length and hash of the text that they decode to."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = digests(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return found.select(
        F.col("id").alias("doc_id"), "n_ids", "ids_crc32", F.char_length("text").alias("n_chars"), F.sha2("text", 256).alias("text_sha256")
    )
