"""SentencePiece encoding by batched numpy dynamic programming, and decoding.

Texts become units that no piece crosses: a run of blanks with the word after it, or a character
that is in no longer piece. Distinct units of equal length advance together, one position at a time:
substring hashes are looked up in the sorted hashes of all pieces, and the best last piece of each
prefix is kept as a backpointer.

A unigram model takes the largest sum of scores. A model of merges (BPE) has no scores to add: of the
pieces that may end a prefix, exactly one is compatible with the piece before it, that is, the merges
of the two pieces' text give just these two. So its maxima are taken over compatible candidates, and
the ids are those of the model's own encoder.
"""

import re
from functools import partial
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import types as T

from basketlens.llm.common import opened, share, sliced

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
#: Units a task remembers, and bytes of text whose units it holds as Python strings at once.
MEMORY = 300_000
SLICE = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BITS = 19


class Pieces:
    """Pieces, scores and lookup tables of a model; the number of pieces bounds its size."""

    def __init__(self, path=MODEL):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        self.text = [model.id_to_piece(i) for i in ids]
        self.unknown = model.unk_id()
        self.byte = np.full(256, -1)
        usable = []
        for i in ids:
            if model.is_byte(i):
                self.byte[int(self.text[i][3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                usable.append(i)
        self.score = np.array([model.get_score(i) for i in ids])
        self.id = {self.text[i]: i for i in usable}
        from sentencepiece import sentencepiece_model_pb2
        proto = sentencepiece_model_pb2.ModelProto.FromString(model.serialized_model_proto())
        self.merges = proto.trainer_spec.model_type == 2
        self.prefix = proto.normalizer_spec.add_dummy_prefix
        if proto.normalizer_spec.name != "identity" or \
                proto.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("only models without normalisation are supported")
        if any(BLANK in p.lstrip(BLANK) for p in self.id):
            raise ValueError("a piece crosses a blank")
        hashes = np.array([_hash(p) for p in self.id], np.uint64)
        order = np.argsort(hashes)
        self.keys, self.ids = hashes[order], np.array(list(self.id.values()))[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces have equal hashes")
        # Most substrings are no piece: a table of leading hash bits spares their lookup.
        self.maybe = np.zeros(1 << _BITS, bool)
        self.maybe[(self.keys >> np.uint64(64 - _BITS)).astype(np.int64)] = True
        self.longest = max(map(len, self.id))
        self.lengths = np.array([len(t) for t in self.text])
        self.inside = {c for p in self.id if len(p) > 1 for c in p}


def _hash(piece):
    value = np.uint64(0)
    with np.errstate(over="ignore"):
        for c in piece:
            value = value * _BASE + np.uint64(ord(c) + 1)
    return value


class Encoder:
    """Encodes texts with the pieces of a model; remembers units and compatible pairs."""

    def __init__(self, pieces):
        self.pieces = pieces
        self.pairs, self.fits, self.recent = np.array([-1]), np.array([False]), {}
        self.reset()

    def reset(self):
        self.number, self.pool = {}, np.empty(1 << 16, np.int32)
        self.starts, self.sizes = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int32)
        self.used = 0

    # --- model of merges ---------------------------------------------------------------------

    def merged(self, symbols):
        """Symbols after all merges: the best-scored neighbours first, the leftmost of equals."""
        ids, score, symbols = self.pieces.id, self.pieces.score, list(symbols)
        while True:
            best, place = None, -1
            for i in range(len(symbols) - 1):
                found = ids.get(symbols[i] + symbols[i + 1])
                if found is not None and (best is None or score[found] > best):
                    best, place = score[found], i
            if best is None:
                return symbols
            symbols[place:place + 2] = [symbols[place] + symbols[place + 1]]

    def compatible(self, before, after):
        """Whether merging the text of two pieces gives these two; -1 stands for no piece."""
        text = self.pieces.text
        codes = (before + 1) * len(text) + after
        spot = np.minimum(np.searchsorted(self.pairs, codes), len(self.pairs) - 1)
        out = self.fits[spot]
        missed = np.flatnonzero(self.pairs[spot] != codes)
        if len(missed):
            new, index = np.unique(codes[missed], return_inverse=True)
            fits = np.empty(len(new), bool)
            for k, code in enumerate(new.tolist()):
                if code not in self.recent:
                    a, b = code // len(text) - 1, code % len(text)
                    want = [text[b]] if a < 0 else [text[a], text[b]]
                    self.recent[code] = self.merged("".join(want)) == want
                fits[k] = self.recent[code]
            out[missed] = fits[index]
            if len(self.recent) > 30_000:
                codes = np.concatenate((self.pairs, np.fromiter(self.recent, np.int64)))
                known = np.concatenate((self.fits, np.fromiter(self.recent.values(), bool)))
                order = np.argsort(codes)
                self.pairs, self.fits, self.recent = codes[order], known[order], {}
        return out

    # --- dynamic programming -----------------------------------------------------------------

    def _solve(self, units):
        """(ids of all units of equal length one after the other, their counts)."""
        p, length, rows = self.pieces, len(units[0]), len(units)
        codes = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"),
                              np.uint32).astype(np.uint64).reshape(rows, length)
        total = np.full((rows, length + 1), -np.inf)
        total[:, 0] = 0
        last = np.full((rows, length + 1), -1)
        back = np.zeros((rows, length + 1), np.int64)
        each = np.arange(rows)
        # hashes[i]: hash of the substring from i to the current position.
        hashes = np.zeros((rows, length), np.uint64)
        for end in range(1, length + 1):
            with np.errstate(over="ignore"):
                first = max(0, end - p.longest)
                hashes[:, first:end] = hashes[:, first:end] * _BASE + (
                    codes[:, end - 1:end] + np.uint64(1))
            window = hashes[:, first:end]
            found = np.full(window.shape, -1)
            at = np.nonzero(p.maybe[(window >> np.uint64(64 - _BITS)).astype(np.int64)])
            probe = window[at]
            spot = np.minimum(np.searchsorted(p.keys, probe), len(p.keys) - 1)
            found[at] = np.where(p.keys[spot] == probe, p.ids[spot], -1)
            # A single character without a piece stands alone, as an unknown one.
            found[:, -1] = np.where(found[:, -1] < 0, p.unknown, found[:, -1])
            row, start = np.nonzero((found >= 0) & (total[:, first:end] > -np.inf))
            piece, start = found[row, start], start + first
            if p.merges:
                fits = self._fitting(found, first, row, start, piece, last, back)
                value = np.where(fits, 0.0, -np.inf)
            else:
                value = total[row, start] + np.where(
                    piece == p.unknown, p.score.min() - 10, p.score[piece])
            values = np.full((rows, end - first), -np.inf)
            values[row, start - first] = value
            best = values.argmax(axis=1)
            total[:, end] = values[each, best]
            last[:, end] = found[each, best]
            back[:, end] = best + first
        at, live, row, begin, piece = np.full(rows, length), each, [], [], []
        while len(live):
            row.append(live)
            piece.append(last[live, at[live]])
            at[live] = back[live, at[live]]
            begin.append(at[live])
            live = live[at[live] > 0]
        row, begin, piece = map(np.concatenate, (row, begin, piece))
        order = np.lexsort((begin, row))
        row, begin, piece = row[order], begin[order], piece[order]
        if (strange := np.flatnonzero(piece == p.unknown)).size:
            row, piece = self._as_bytes(units, row, begin, piece, strange)
        return piece.astype(np.int32), np.bincount(row, minlength=rows)

    def _fitting(self, found, first, row, start, piece, last, back):
        """Which candidates of a model of merges are compatible with the piece before them."""
        unknown = self.pieces.unknown
        before = np.where(start == 0, -1, last[row, start])
        # An unknown character merges with nothing: what stands beside it must be whole by itself.
        after_unknown = (before == unknown) & (start > 0)
        before = np.where(after_unknown, -1, before)
        fits = piece == unknown
        # Two pieces whose text is a piece would have been merged.
        origin = back[row, start] - first
        joined = (before >= 0) & (origin >= 0) & (found[row, np.maximum(origin, 0)] >= 0)
        ask = np.flatnonzero(~fits & ~joined)
        fits[ask] = self.compatible(before[ask], piece[ask])
        return fits

    def _as_bytes(self, units, row, begin, piece, strange):
        """Unknown characters as the pieces of their bytes, if the model has those."""
        rows, pieces = row.tolist(), piece.tolist()
        parts = [[x] for x in pieces]
        for k in strange.tolist():
            raw = units[rows[k]][begin[k]].encode("utf-8", "surrogatepass")
            ids = self.pieces.byte[list(raw)]
            if ids.min() >= 0:
                parts[k] = ids.tolist()
        return (np.repeat(row, list(map(len, parts))),
                np.array([x for part in parts for x in part], np.int64))

    def _learn(self, units):
        """Remember the ids of units not seen before, in batches of equal length."""
        by_length = {}
        for unit in units:
            by_length.setdefault(len(unit), []).append(unit)
        for length, some in by_length.items():
            step = max(1, 200_000 // (length + 1))
            for part in range(0, len(some), step):
                batch = some[part:part + step]
                ids, sizes = self._solve(batch)
                n, m = len(self.number), len(batch)
                while n + m > len(self.starts):
                    self.starts = np.concatenate((self.starts, np.empty_like(self.starts)))
                    self.sizes = np.concatenate((self.sizes, np.empty_like(self.sizes)))
                while self.used + len(ids) > len(self.pool):
                    self.pool = np.concatenate((self.pool, np.empty_like(self.pool)))
                self.number.update(zip(batch, range(n, n + m)))
                self.starts[n:n + m] = self.used + np.cumsum(sizes) - sizes
                self.sizes[n:n + m] = sizes
                self.pool[self.used:self.used + len(ids)] = ids
                self.used += len(ids)

    def encode(self, texts):
        """(ids, offsets) of all texts, one after the other."""
        if len(self.number) > MEMORY:
            self.reset()
        split = self.pattern.findall
        lists = [split(BLANK * self.pieces.prefix + t.replace(" ", BLANK)) if t else []
                 for t in texts]
        flat = list(chain.from_iterable(lists))
        index = np.fromiter(map(self.number.get, flat, repeat(-1)), np.int64, len(flat))
        if (new := np.flatnonzero(index < 0)).size:
            unseen = [flat[i] for i in new.tolist()]
            self._learn(dict.fromkeys(unseen))
            index[new] = np.fromiter(map(self.number.__getitem__, unseen), np.int64, len(unseen))
        begins, counts = self.starts[index], self.sizes[index]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        ramp = np.arange(total) - np.repeat(ends - counts, counts)
        ids = self.pool[np.repeat(begins, counts) + ramp]
        units = np.cumsum([0, *map(len, lists)])
        return ids, np.concatenate(([0], ends))[units]

    @property
    def pattern(self):
        """Units: blanks with a word, or one character that no longer piece holds."""
        if not hasattr(self, "_pattern"):
            single = "".join(c for c in "\n\t\r" if c not in self.pieces.inside) or "\0"
            self._pattern = re.compile(f"[{single}]|{BLANK}*[^{BLANK}{single}]+|{BLANK}+")
        return self._pattern


def decode(pieces, ids):
    """The text of a list of ids: byte pieces are joined as UTF-8, blanks restored."""
    value = {int(i): bytes([b]) for b, i in enumerate(pieces.byte) if i >= 0}
    raw = b"".join(value.get(i) or pieces.text[i].encode() for i in ids)
    text = raw.decode("utf-8", "replace").replace(BLANK, " ")
    return text[1:] if pieces.prefix and text.startswith(" ") else text


def _decoded(pieces, ids, offsets):
    """Texts of encoded rows, with the bytes of every piece prepared once."""
    plain = [t.replace(BLANK, " ").encode() for t in pieces.text]
    for b, i in enumerate(pieces.byte.tolist()):
        if i >= 0:
            plain[i] = bytes([b])
    listed, cuts = ids.tolist(), offsets.tolist()
    out = []
    for start, end in zip(cuts, cuts[1:]):
        raw = b"".join(map(plain.__getitem__, listed[start:end]))
        text = raw.decode("utf-8", "replace")
        out.append(text[1:] if pieces.prefix and text.startswith(" ") else text)
    return out


def _rows(batches, shared, width):
    pieces = opened(shared)
    encoder = Encoder(pieces)
    for whole in batches:
        for batch in sliced(whole, "text", SLICE):
            texts = [t or "" for t in batch["text"].to_pylist()]
            ids, offsets = encoder.encode(texts)
            back = _decoded(pieces, ids, offsets)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))
            columns = [batch[n] for n in batch.schema.names[:width]]
            yield pa.RecordBatch.from_arrays(
                columns + [lists, pa.array(np.diff(offsets)), pa.array(back),
                           pa.array([a == b for a, b in zip(texts, back)])],
                [*batch.schema.names[:width], "ids", "n_ids", "decoded", "exact"])


def encode(docs, path=MODEL):
    """docs with ids, n_ids, decoded (the text of the ids) and exact (decoded equals the text).

    Null and empty texts have no ids and decode to the empty text. Every text round-trips but one
    that holds the blank mark U+2581 itself, which decodes to a space; exact is false for it. Other
    columns pass through, except that the four are replaced. Repeated rows are encoded alike; an
    empty table stays empty.
    """
    rows = docs.drop("ids", "n_ids", "decoded", "exact")
    shared = share(docs.sparkSession, Pieces(path))
    schema = T.StructType([
        *rows.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("n_ids", T.LongType()), T.StructField("decoded", T.StringType()),
        T.StructField("exact", T.BooleanType())])
    return rows.mapInArrow(partial(_rows, shared=shared, width=len(rows.columns)), schema)
