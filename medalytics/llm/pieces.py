"""Sampled segmentations of texts into pieces: forward filtering, backward sampling; decoding is lossless."""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE_MARK = "▁"
SLOT_BITS = 19
BLOCK = 1 << 19
PLACE_BITS = 32
#: Up to so many bytes a string is a number by itself; longer ones have a hash, and their bytes are compared.
SHORT = 8
ODD = np.uint64(0x9E3779B97F4A7C15)


def _byte_codes():
    draw = np.random.default_rng(11)
    base = int(draw.integers(0, 1 << 64, dtype=np.uint64)) | 1
    return draw.integers(0, 1 << 64, 256, np.uint64), base


@dataclass(frozen=True)
class Vocabulary:
    """Pieces as bytes and their log-weights; `fallback` holds the id of every single byte, weighing `floor`."""

    pieces: list
    log_p: np.ndarray
    fallback: np.ndarray
    floor: float


def vocabulary(path: str, floor: float = -24.0) -> Vocabulary:
    """Read a model file with byte fallback. The mark of a space becomes a space.

    A merge list has ranks for scores, so a piece weighs the log of one over its rank. Byte pieces weigh
    `floor`: they are taken where nothing else fits, and are possible everywhere.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, scores, fallback = [], [], np.full(256, -1)
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            fallback[int(model.id_to_piece(i)[3:5], 16)] = i
        usable = not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        pieces.append(model.id_to_piece(i).replace(SPACE_MARK, " ").encode() if usable else b"")
        scores.append(model.get_score(i))
    if (fallback < 0).any():
        raise ValueError("the pieces need a fallback for every byte")
    ranks = np.argsort(np.argsort(-np.array(scores), kind="stable"))
    return Vocabulary(pieces, -np.log(ranks + 1.0), fallback, floor)


def _mixed(x):
    """The bits of 64-bit numbers well mixed."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _numbers(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place as one number, zeros after the end."""
    padded = np.r_[data, np.zeros(SHORT, np.uint8)].astype(np.uint64)
    found = np.zeros(len(data), np.uint64)
    for i in range(SHORT):
        found |= padded[i : i + len(data)] << np.uint64(8 * i)
    return found


def _short_keys(numbers: np.ndarray, length: int) -> np.ndarray:
    """Keys of the strings of `length` bytes at the front of the numbers: equal only for equal strings of this length."""
    if length < SHORT:
        numbers = numbers & np.uint64((1 << (8 * length)) - 1) | np.uint64(length << 56)
    return numbers * ODD


class Sampler:
    """Encodes and decodes texts with one vocabulary.

    Texts are cut into units before single spaces and around line feeds. No piece crosses such a cut, so the
    lattice of a text is a chain of the lattices of its units, and equal units of a block share one lattice.
    """

    def __init__(self, vocabulary: Vocabulary, alpha: float = 1.0):
        self.v, self.alpha = vocabulary, alpha
        self.codes, base = _byte_codes()
        n = 2 * BLOCK
        self.powers, self.inverses = _powers(base, n), _powers(pow(base, -1, 1 << 64), n)
        ids = np.array([i for i, p in enumerate(vocabulary.pieces) if p], np.int64)
        ids = ids[[b"\n" not in vocabulary.pieces[i] and b" " not in vocabulary.pieces[i].lstrip(b" ") for i in ids]]
        texts = [vocabulary.pieces[i] for i in ids]
        data = np.frombuffer(b"".join(texts), np.uint8)
        sums, _ = self._sums(data)
        size = np.array([len(t) for t in texts])
        first = np.cumsum(size) - size
        hashed = self._hash(sums, first, first + size)
        numbers = _numbers(data)[first]
        for length in range(1, SHORT + 1):
            hashed[size == length] = _short_keys(numbers[size == length], length)
        order = np.argsort(hashed)
        self.hashes, self.ids, self.sizes = hashed[order], ids[order], size[order]
        if (self.hashes[1:] == self.hashes[:-1]).any():
            raise ValueError("two pieces have one hash; choose another seed of the byte codes")
        slot, at, count = np.unique(self.hashes >> np.uint64(64 - SLOT_BITS), return_index=True, return_counts=True)
        self.slots, self.crowd = np.full(1 << SLOT_BITS, -1, np.int32), int(count.max())
        self.slots[slot] = at  # pieces of one slot follow each other
        self.lengths = sorted({len(t) for t in texts}, reverse=True)
        spelled = [p if p else b"" for p in vocabulary.pieces]
        for b, i in enumerate(vocabulary.fallback):
            spelled[i] = bytes([b])
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelled_length = np.array([len(p) for p in spelled])
        self.spelled_start = np.r_[0, np.cumsum(self.spelled_length)[:-1]]

    def _sums(self, data):
        if len(data) >= len(self.powers):  # a unit longer than two blocks
            _, base = _byte_codes()
            self.powers, self.inverses = _powers(base, len(data) + 1), _powers(pow(base, -1, 1 << 64), len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.codes[data] * self.powers[: len(data)], out=sums[1:])
        return sums, len(data)

    def _hash(self, sums, start, end):
        return (sums[end] - sums[start]) * self.inverses[start] * np.uint64(0x9E3779B97F4A7C15)

    @staticmethod
    def cut(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """First bytes of all units; `starts` are the first bytes of the texts."""
        line, space = data == 10, data == 32
        begin = np.zeros(len(data), bool)
        begin[starts[starts < len(data)]] = True
        begin |= line
        begin[1:] |= line[:-1]
        following = np.ones(len(data), bool)
        following[:-1] = ~space[1:] & ~line[1:]
        last = np.r_[starts[1:], len(data)] - 1
        following[last[(last >= 0)]] = False
        return np.flatnonzero(begin | (space & following))

    def _lattice(self, data, size):
        """Edges of the lattices of units that follow each other in `data`, as (end node, start node, piece, cumulative share), ordered by end node.

        Node numbers count the places between bytes, unit after unit. Forward filtering sums the weights of
        all segmentations up to each place, one place of all units at a time; an edge's share is the chance
        that backward sampling takes it from its end.
        """
        first = np.r_[0, np.cumsum(size + 1)[:-1]]
        unit = np.repeat(np.arange(len(size)), size)
        offset = np.arange(len(unit)) - np.repeat(np.cumsum(size) - size, size)
        node, left = first[unit] + offset, size[unit] - offset
        sums, n = self._sums(data)
        numbers = _numbers(data)
        ends, begins, piece, weight = [], [], [], []
        for length in self.lengths:
            if length > n:
                continue
            fits = np.flatnonzero(left[: n - length + 1] >= length)
            if length <= SHORT:
                hashed = _short_keys(numbers[fits], length)
            else:
                hashed = self._hash(sums, slice(0, n - length + 1), slice(length, n + 1))[fits]
            slot = self.slots[hashed >> np.uint64(64 - SLOT_BITS)]
            likely = np.flatnonzero(slot >= 0)
            slot, hashed = slot[likely], hashed[likely]
            for _ in range(1, self.crowd):
                slot += (self.hashes[slot] != hashed) & (slot + 1 < len(self.hashes))
            hit = (self.hashes[slot] == hashed) & (self.sizes[slot] == length)
            fits, ids = fits[likely[hit]], self.ids[slot[hit]]
            if length > SHORT and len(fits):
                spot, spelled = np.arange(length), self.spelled_start[ids]
                same = (data[fits[:, None] + spot] == self.spelled[spelled[:, None] + spot]).all(axis=1)
                fits, ids = fits[same], ids[same]
            begins.append(node[fits])
            ends.append(node[fits] + length)
            piece.append(ids)
            weight.append(self.v.log_p[ids] * self.alpha)
        ends.append(node + 1)
        begins.append(node)
        piece.append(self.v.fallback[data])
        weight.append(np.full(len(node), self.v.floor))
        end, begin, piece, weight = (np.concatenate(x) for x in (ends, begins, piece, weight))
        order = np.argsort(end, kind="stable")
        end, begin, piece, weight = end[order], begin[order], piece[order], weight[order]

        total = np.zeros(int(first[-1] + size[-1] + 1))
        share = np.zeros(len(end))
        nodes, head = np.unique(end, return_index=True)
        count = np.diff(np.r_[head, len(end)])
        place = nodes - first[np.searchsorted(first, nodes, "right") - 1]
        by_place = np.argsort(place, kind="stable")
        steps = np.searchsorted(place[by_place], np.arange(1, (place.max() if len(place) else 0) + 2))
        for a, b in zip(steps[:-1], steps[1:]):
            some = by_place[a:b]
            n = count[some]
            heads = np.cumsum(n) - n
            edge = np.repeat(head[some] - heads, n) + np.arange(n.sum())
            value = total[begin[edge]] + weight[edge]
            top = np.repeat(np.maximum.reduceat(value, heads), n)
            part = np.exp(value - top)
            whole = np.add.reduceat(part, heads)
            total[nodes[some]] = top[heads] + np.log(whole)
            running = np.cumsum(part / np.repeat(whole, n))
            share[edge] = running - np.repeat(running[heads] - part[heads] / whole, n)
        return first, nodes, head, begin, piece, share

    def encode(self, texts: list[bytes], seeds: np.ndarray, unit_zero: np.ndarray):
        """(ids, number of ids per text, number of units per text) for one block of texts.

        The draw for a piece depends on the text's seed, the number of its unit and the step back from the
        unit's end only, so it does not matter which texts share a block.
        """
        sizes = np.array([len(t) for t in texts])
        data = np.frombuffer(b"".join(texts), np.uint8)
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        starts = np.cumsum(sizes) - sizes
        begin = self.cut(data, starts[sizes > 0])
        end = np.r_[begin[1:], len(data)]
        text = np.searchsorted(np.cumsum(sizes), begin, "right")
        units = np.bincount(text, minlength=len(texts))
        number = np.arange(len(begin)) - np.repeat(np.cumsum(units) - units, units) + unit_zero[text]
        sums, _ = self._sums(data)
        one, of = self._kinds(data, self._hash(sums, begin, end), begin, end)
        width = (end - begin)[one]
        byte = np.repeat(begin[one] - (np.cumsum(width) - width), width) + np.arange(width.sum())
        first, nodes, head, back, piece, share = self._lattice(data[byte], width)

        marks = np.minimum(share * float(1 << PLACE_BITS), float(1 << PLACE_BITS)).astype(np.uint64)
        marks[np.r_[head[1:], len(share)] - 1] = 1 << PLACE_BITS
        head_of = np.full(int(first[-1] + width[-1] + 1), -1)
        head_of[nodes] = head

        key = _mixed(seeds[text].view(np.uint64) + (number.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        who = np.argsort(of, kind="stable")  # equal units together, so their lattice stays at hand
        node, stop = (first[of] + (end - begin))[who], first[of]
        taken, count, step = [], np.zeros(len(begin), np.int64), 0
        while len(who):
            draw = _mixed(key[who] + np.uint64(step)) >> np.uint64(64 - PLACE_BITS)
            edge = head_of[node]
            over = np.flatnonzero(marks[edge] <= draw)
            while len(over):
                edge[over] += 1
                over = over[marks[edge[over]] <= draw[over]]
            taken.append((who, piece[edge]))
            count[who] += 1
            node = back[edge]
            going = node > stop[who]
            who, node, step = who[going], node[going], step + 1
        final = np.cumsum(count)
        ids = np.empty(int(final[-1]), np.int64)
        for step, (who, some) in enumerate(taken):
            ids[final[who] - 1 - step] = some
        per_text = np.bincount(text, weights=count, minlength=len(texts)).astype(np.int64)
        return ids, per_text, units

    @staticmethod
    def _kinds(data, hashed, begin, end):
        """(one unit of each kind, kind of every unit): units are of one kind if their bytes are the same.

        Units of one hash are compared byte by byte with the first of them; those that differ are told apart by
        their bytes.
        """
        _, one, of = np.unique(hashed, return_index=True, return_inverse=True)
        size, like = end - begin, begin[one[of]]
        other = size != size[one[of]]
        place = np.arange(len(data)) + np.repeat(np.where(other, 0, like - begin), size)
        other |= np.logical_or.reduceat(data != data[place], begin)
        if other.any():
            kinds, found = {}, [one]
            for i in np.flatnonzero(other):
                bytes_ = data[begin[i] : end[i]].tobytes()
                if bytes_ not in kinds:
                    kinds[bytes_] = len(one) + len(kinds)
                    found.append([i])
                of[i] = kinds[bytes_]
            one = np.concatenate(found)
        return one, of

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that a sequence of ids stands for."""
        n = self.spelled_length[ids]
        at = np.repeat(self.spelled_start[ids] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return self.spelled[at].tobytes()


def _powers(base, n):
    steps = np.full(n, base, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def _parts(text: bytes, size: int):
    """A long text in parts of about `size` bytes, cut where units are cut; a unit is never cut."""
    at = 0
    while len(text) - at > size:
        cut = max(text.rfind(b"\n", at + 1, at + size), _unit_space(text, at, at + size))
        if cut <= at:
            following = [x for x in (text.find(b"\n", at + size), _next_space(text, at + size)) if x > at]
            if not following:
                break
            cut = min(following)
        yield text[at:cut]
        at = cut
    yield text[at:]


def _unit_space(text, low, high):
    while (at := text.rfind(b" ", low + 1, high)) > low:
        if at + 1 < len(text) and text[at + 1] not in b" \n":
            return at
        high = at
    return -1


def _next_space(text, low):
    while (at := text.find(b" ", low)) >= 0:
        if at + 1 < len(text) and text[at + 1] not in b" \n":
            return at
        low = at + 1
    return -1


def sampled(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text", alpha: float = 0.25, seed: int = 5) -> DataFrame:
    """(doc_id, n_bytes, n_pieces, ids, lossless) per row.

    `ids` is one segmentation, drawn with the chance that its pieces' weights to the power `alpha` give it
    (1: by the weights, near 0: all alike); the draws follow the row's id and the seed, so a row gets the same one in every run and every place.
    `lossless` says that decoding gave the text's bytes back: it does, whatever the text holds, as units and pieces
    are told apart by their bytes and not by a hash alone. Null and
    empty texts have no pieces; rows without an id share one series of draws. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(id_col).cast("string"), F.lit(seed)).alias("seed"), text.alias("text"))
    schema = T.StructType([rows.schema["doc_id"]]).add("n_bytes", "long").add("n_pieces", "long").add("ids", T.ArrayType(T.IntegerType())).add("lossless", "boolean")

    def encode(batches):
        sampler = Sampler(vocabulary, alpha)
        for batch in (whole.slice(at, 500) for whole in batches for at in range(0, whole.num_rows, 500)):
            texts, seeds = batch.column("text").to_pylist(), batch.column("seed").to_numpy()
            i = 0
            while i < len(texts):
                j, size = i, 0
                while j < len(texts) and (j == i or size + len(texts[j]) <= BLOCK):
                    size += len(texts[j])
                    j += 1
                if size > BLOCK:
                    found, unit = [], 0
                    for part in _parts(texts[i], BLOCK):
                        ids, _, units = sampler.encode([part], seeds[i:j], np.array([unit]))
                        found.append(ids)
                        unit += int(units[0])
                    ids = np.concatenate(found)
                    counts = np.array([len(ids)])
                else:
                    ids, counts, _ = sampler.encode(texts[i:j], seeds[i:j], np.zeros(j - i, np.int64))
                yield _encoded(batch.column("doc_id").slice(i, j - i), texts[i:j], ids, counts, sampler)
                i = j

    return rows.mapInArrow(encode, schema)


def _encoded(names, texts, ids, counts, sampler):
    ends = np.cumsum(counts)
    decoded = sampler.decode(ids)
    sizes = [len(t) for t in texts]
    lengths = np.r_[0, np.cumsum(sampler.spelled_length[ids])]
    edges = lengths[np.r_[0, ends]].tolist()
    same = [decoded[a:b] == t for a, b, t in zip(edges, edges[1:], texts)]
    lists = pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(ids, pa.int32()))
    columns = [names, pa.array(sizes, pa.int64()), pa.array(counts), lists, pa.array(same, pa.bool_())]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_pieces", "ids", "lossless"])
