"""SentencePiece encoding with source spans, and decoding.

1. Normalise: at every place the longest prefix that the model's compiled character map
   knows is replaced, any other character is kept; spaces become the mark U+2581. The byte
   of the source that each normalised byte came from is recorded on the way.
2. Cut the normalised text before every run of marks. No piece of the vocabulary reaches
   over such a cut, so segments merge independently; equal segments are merged once per
   worker and remembered.
3. Merge the pairs of a segment, best score first, leftmost first among equals. A character
   without a piece becomes its UTF-8 bytes.
4. The lengths of the pieces give their ends in the normalised text, and the record of step 1
   projects these to byte spans of the source.

Every row is encoded by itself in Arrow batches; nothing is shuffled. The model is read by
the driver and goes to the tasks with their code (half a megabyte).
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F
from sentencepiece import sentencepiece_model_pb2

from .common import prepare, read_table, slices, strings, text_of

MODEL_FILE = public_tokenizers.path("piece_bpe_32k.model")
MARK = "▁"
_MARK = MARK.encode()
_SPACE = 0x20
#: Segments that a worker remembers; when there are more, it begins anew.
REMEMBERED = 400_000
#: Up to so many characters, segments of one length are merged together.
LONG_SEGMENT = 32
#: Texts are encoded together up to about so many characters.
SLICE = 1 << 20
#: Kinds of pieces in a model file (fixed values).
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
_BPE = 2


class CharacterMap:
    """The compiled map: a double-array trie over UTF-8 keys and the replacements."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
        self.replacements = blob[4 + size :]

    @staticmethod
    def _step(unit: int) -> int:
        return (unit >> 10) << ((unit >> 6) & 8)

    def longest(self, text: bytes, at: int) -> tuple[bytes, int] | None:
        """Replacement and length of the longest known prefix at a place."""
        units, found = self.units, None
        node = self._step(units[0])
        for end in range(at, len(text)):
            node ^= text[end]
            unit = units[node]
            if unit & 0x800000FF != text[end]:
                break
            node ^= self._step(unit)
            if unit >> 8 & 1:
                found = units[node] & 0x7FFFFFFF, end + 1 - at
        if not found:
            return None
        start, length = found
        return self.replacements[start : self.replacements.index(0, start)], length


class _Numbered(dict):
    """Keys numbered in the order of their first look-up; new ones are noted."""

    def __init__(self):
        self.fresh: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        self.fresh.append(key)
        return number


def _key_of(segment: str) -> str:
    """Segments with one mark lose it; without a mark one is put behind, so that no two share a key."""
    if not segment.startswith(MARK):
        return segment + MARK
    return segment if segment.startswith(MARK * 2) else segment[1:]


def _segment_of(key: str) -> str:
    if key.startswith(MARK):
        return key
    return key[:-1] if key.endswith(MARK) else MARK + key


class PieceModel:
    """Normaliser, merges and pieces of one model file."""

    _instances: dict[bytes, PieceModel] = {}

    @classmethod
    def shared(cls, data: bytes) -> PieceModel:
        """One per worker process and model."""
        key = xxhash.xxh3_128_digest(data)
        if key not in cls._instances:
            cls._instances[key] = cls(data)
        return cls._instances[key]

    def __init__(self, data: bytes):
        model = sentencepiece_model_pb2.ModelProto.FromString(data)
        spec = model.normalizer_spec
        kinds = {p.type for p in model.pieces}
        if model.trainer_spec.model_type != _BPE or not model.trainer_spec.byte_fallback:
            raise ValueError("only pair merging models with byte fallback are supported")
        if kinds - {NORMAL, UNKNOWN, CONTROL, BYTE} or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("models with user-defined or unused pieces, or marks behind words, are not supported")
        self.map = CharacterMap(spec.precompiled_charsmap) if spec.precompiled_charsmap else None
        self.prefix, self.trim, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        self.scores = {p.piece: (p.score, i) for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.cut = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in self.scores):
            raise ValueError("models with pieces that reach over the begin of a word are not supported")
        self._forget()
        self._pair_table()
        sizes = [len(p.piece.encode()) for p in model.pieces]
        self.piece_size = np.array(sizes, np.int32)
        self.shrink = np.array([2 * p.piece.count(MARK) if p.type == NORMAL else 0 for p in model.pieces], np.int64)
        # What each id decodes to.
        self.kinds = np.array([p.type for p in model.pieces], np.uint8)
        surfaces = [self._surface(p, model.trainer_spec.unk_surface) for p in model.pieces]
        self.surface = np.frombuffer(b"".join(surfaces), np.uint8)
        self.surface_size = np.array([len(s) for s in surfaces], np.int64)
        self.surface_at = np.cumsum(self.surface_size) - self.surface_size
        self.marked = np.array([p.piece.startswith(MARK) for p in model.pieces]) & (self.kinds == NORMAL)

    @staticmethod
    def _surface(piece, unknown: str) -> bytes:
        if piece.type == BYTE:
            return bytes([int(piece.piece[1:-1], 16)])
        if piece.type == CONTROL:
            return b""
        return (unknown if piece.type == UNKNOWN else piece.piece.replace(MARK, " ")).encode()

    # ------------------------------------------------------------------ normalising

    def _characters(self, raw: bytes) -> Iterator[tuple[bytes, int]]:
        """Normalised bytes and how many bytes of the source they stand for, from left to right."""
        at = 0
        while at < len(raw):
            found = self.map.longest(raw, at) if self.map else None
            if not found:
                lead = raw[at]
                size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                found = raw[at : at + size], size
            yield found
            at += found[1]

    def normalise(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised text, and for each of its bytes and its end the place in the source."""
        if not raw:
            return b"", np.zeros(1, np.int32)
        if not self.map and not self.trim and self.escape:
            source = np.frombuffer(raw, np.uint8)
            places = np.repeat(np.arange(len(raw), dtype=np.int32), np.where(source == _SPACE, 3, 1))
            head = [0] * len(_MARK) if self.prefix else []
            text = raw.replace(b" ", _MARK)
            return (_MARK + text if self.prefix else text), np.concatenate(
                [np.array(head, np.int32), places, np.array([len(raw)], np.int32)]
            )
        text, origin = bytearray(), []
        at, after_space = 0, self.trim
        space = _MARK if self.escape else b" "
        for piece, used in self._characters(raw):
            if self.trim and after_space:
                piece = piece.lstrip(b" ")
            if piece:
                if not text and self.prefix:
                    text += space
                    origin += [at] * len(space)
                shown = piece.replace(b" ", space)
                text += shown
                origin += [at] * len(shown)
                after_space = self.trim and piece.endswith(b" ")
            at += used
        if not text and self.prefix and not self.trim:
            text, origin = bytearray(space), [0] * len(space)
        if self.trim:
            while text.endswith(space):
                at = origin[len(text) - len(space)]
                del text[-len(space) :]
        return bytes(text), np.array([*origin[: len(text)], at], np.int32)

    # ---------------------------------------------------------------------- merging

    def merge(self, segment: str) -> list[tuple[int, int]]:
        """Ids and lengths in normalised bytes. Of a character given as bytes, the last one has its length."""
        parts = list(segment)
        left, right = list(range(-1, len(parts) - 1)), [*range(1, len(parts)), -1]
        agenda: list[tuple[float, int, int, int]] = []

        def propose(a: int, b: int) -> None:
            if a >= 0 and b >= 0 and (known := self.scores.get(parts[a] + parts[b])):
                heapq.heappush(agenda, (-known[0], a, b, len(parts[a]) + len(parts[b])))

        for i in range(len(parts) - 1):
            propose(i, i + 1)
        while agenda:
            _, a, b, size = heapq.heappop(agenda)
            # Out of date where one of the two has been merged meanwhile.
            if not parts[a] or not parts[b] or len(parts[a]) + len(parts[b]) != size:
                continue
            parts[a] += parts[b]
            parts[b] = ""
            right[a] = right[b]
            if right[a] >= 0:
                left[right[a]] = a
            propose(left[a], a)
            propose(a, right[a])
        found = []
        for part in filter(None, parts):
            raw = part.encode()
            if known := self.scores.get(part):
                found.append((known[1], len(raw)))
            else:
                found += [(self.bytes[b], 0) for b in raw[:-1]] + [(self.bytes[raw[-1]], len(raw))]
        return found

    def _pair_table(self) -> None:
        """All pairs of pieces that merge: sorted keys, place in the order of scores, and the merged piece."""
        ids = {p: i for p, (_, i) in self.scores.items()}
        best = {score: rank for rank, score in enumerate(sorted({s for s, _ in self.scores.values()}, reverse=True))}
        found = []
        for piece, (score, i) in self.scores.items():
            for cut in range(1, len(piece)):
                a, b = ids.get(piece[:cut]), ids.get(piece[cut:])
                if a is not None and b is not None:
                    found.append((a << 32 | b, best[score], i))
        found.sort()
        self.pair_key, self.pair_rank, self.pair_piece = (np.array(c, np.int64) for c in zip(*[*found, (1 << 62, 0, 0)]))
        self.single = np.full(0x110000, -1, np.int64)
        for piece, i in ids.items():
            if len(piece) == 1:
                self.single[ord(piece)] = i

    def _merge_alike(self, symbols: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Merge many segments of one length: row numbers and ids of those that are done, round by round.

        Every round merges the best pair of each row, so that all rows lose one symbol.
        """
        row = np.arange(len(symbols))
        while len(row):
            keys = symbols[:, :-1] << 32 | symbols[:, 1:]
            at = np.searchsorted(self.pair_key, keys)
            rank = np.where(self.pair_key[at] == keys, self.pair_rank[at], 1 << 40)
            if symbols.shape[1] == 1:
                yield row, symbols
                return
            best = rank.argmin(axis=1)
            here = np.arange(len(row))
            more = rank[here, best] < 1 << 40
            if not more.all():
                yield row[~more], symbols[~more]
            merged = self.pair_piece[at[here, best]]
            place = np.arange(symbols.shape[1] - 1)
            # Left of the pair as before, behind it one place to the left.
            symbols = np.where(place < best[:, None], symbols[:, :-1], symbols[:, 1:])
            symbols[here, best] = merged
            row, symbols = row[more], symbols[more]

    def _forget(self) -> None:
        self.known = _Numbered()
        self.count, self.first = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int32)

    def _learn(self) -> None:
        """Merge the segments that were seen for the first time."""
        fresh = [_segment_of(k) for k in self.known.fresh]
        self.known.fresh = []
        if not fresh:
            return
        count, first = np.zeros(len(fresh), np.int64), np.zeros(len(fresh), np.int64)
        ids, sizes, used = [self.ids], [self.sizes], len(self.ids)
        length = np.array([len(s) for s in fresh])
        alone = [np.flatnonzero(length > LONG_SEGMENT)]
        for n in np.unique(length[length <= LONG_SEGMENT]):
            rows = np.flatnonzero(length == n)
            text = "".join([fresh[i] for i in rows]).encode("utf-32-le", "surrogatepass")
            symbols = self.single[np.frombuffer(text, "<u4").reshape(-1, n)]
            plain = (symbols >= 0).all(axis=1)
            alone.append(rows[~plain])
            rows = rows[plain]
            for done, pieces in self._merge_alike(symbols[plain]):
                width = pieces.shape[1]
                count[rows[done]] = width
                first[rows[done]] = used + np.arange(len(done)) * width
                ids.append(pieces.ravel().astype(np.int32))
                sizes.append(self.piece_size[ids[-1]])
                used += pieces.size
        for i in np.concatenate(alone):
            merged = self.merge(fresh[i])
            count[i], first[i] = len(merged), used
            ids.append(np.array([m for m, _ in merged], np.int32))
            sizes.append(np.array([n for _, n in merged], np.int32))
            used += len(merged)
        self.first, self.count = np.concatenate([self.first, first]), np.concatenate([self.count, count])
        self.ids, self.sizes = np.concatenate(ids), np.concatenate(sizes)

    def _cut(self, norm: str) -> list[str]:
        """Keys of the segments: the segment without its mark where it begins with exactly one."""
        if norm.startswith(MARK) and MARK * 2 not in norm:
            return norm.split(MARK)[1:]
        return [_key_of(s) for s in self.cut.findall(norm)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """How many pieces each text has, and the ids, begins and ends of all on end."""
        if len(self.known) > REMEMBERED:
            self._forget()
        simple = not self.map and not self.trim and self.escape and self.prefix
        own, pieces, origins = [], [], {}
        for row, text in enumerate(texts):
            if simple and MARK not in text:
                keys = self._cut(MARK + text.replace(" ", MARK)) if text else []
            else:
                norm, origins[row] = self.normalise(text.encode())
                keys = self._cut(norm.decode())
            own += map(self.known.__getitem__, keys)
            pieces.append(len(keys))
        self._learn()
        own = np.array(own, np.int64)
        count = self.count[own]
        ends = np.cumsum(count)
        at = np.repeat(self.first[own] - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)
        ids, sizes = self.ids[at], self.sizes[at].astype(np.int64)
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(pieces, dtype=np.int64)])]
        heads = bounds[:-1][np.diff(bounds) > 0]
        # A mark stands for one byte, the one before the text for none.
        width = sizes - self.shrink[ids]
        width[heads] -= 1
        stops = np.concatenate([[0], np.cumsum(width)])
        base = np.repeat(stops[bounds[:-1]], np.diff(bounds))
        begin, end = (stops[:-1] - base).astype(np.int32), (stops[1:] - base).astype(np.int32)
        for row, origin in origins.items():
            own = slice(bounds[row], bounds[row + 1])
            stop = np.cumsum(sizes[own])
            begin[own], end[own] = origin[stop - sizes[own]], origin[stop]
        return np.diff(bounds), ids, begin, end

    # --------------------------------------------------------------------- decoding

    def _starts(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Which tokens lose the mark they begin with: those that stand for the space before the text."""
        lost = np.zeros(len(ids), bool)
        if not (self.prefix or self.trim):
            return lost
        plain = first[self.kinds[ids[first]] != CONTROL] if not self.trim else first[:0]
        lost[plain] = self.marked[ids[plain]]
        bounds = np.append(first, len(ids))
        for low, high in zip(bounds, bounds[1:]):
            if self.trim or (low < high and self.kinds[ids[low]] == CONTROL):
                for i in range(low, high):
                    if self.kinds[ids[i]] == CONTROL:
                        continue
                    lost[i] = self.marked[ids[i]]
                    if not lost[i] or self.surface_size[ids[i]] > 1 or not self.trim:
                        break
        return lost

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """Texts of token lists that lie on end, with the bounds of the lists."""
        first = bounds[:-1][np.diff(bounds) > 0]
        lost = self._starts(ids, first)
        size = self.surface_size[ids] - lost
        ends = np.cumsum(size)
        at = np.repeat(self.surface_at[ids] + lost - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
        data = self.surface[at].tobytes()
        cuts = np.concatenate([[0], ends])[bounds]
        texts = [data[a:b] for a, b in zip(cuts, cuts[1:])]
        odd = np.add.reduceat(np.append(self.kinds[ids] == BYTE, False), np.minimum(bounds[:-1], len(ids))) if len(texts) else []
        for row in np.flatnonzero(odd):
            if bounds[row] < bounds[row + 1]:
                own = slice(bounds[row], bounds[row + 1])
                texts[row] = self._whole_characters(ids[own], lost[own], texts[row])
        return texts

    def _whole_characters(self, ids: np.ndarray, lost: np.ndarray, text: bytes) -> bytes:
        """Bytes that form no character become one U+FFFD each; bytes join within a run of byte tokens only."""
        if not (self.kinds[ids] == CONTROL).any():
            try:
                text.decode()
                return text
            except UnicodeDecodeError:
                pass
        out, run = [], bytearray()

        def close() -> None:
            while run:
                for size in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[:size]).decode().encode())
                        del run[:size]
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�".encode())
                    del run[0]

        for i, cut in zip(ids.tolist(), lost.tolist()):
            own = self.surface[self.surface_at[i] : self.surface_at[i] + self.surface_size[i]].tobytes()
            if self.kinds[i] == BYTE:
                run += own
            else:
                close()
                out.append(own[cut:])
        close()
        return b"".join(out)


def _model_bytes(model_file: str) -> bytes:
    with open(model_file, "rb") as file:
        return file.read()


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_file: str = MODEL_FILE) -> DataFrame:
    """One row per document: ``doc_id, ids, begins, ends``.

    Piece ``i`` has id ``ids[i]`` and stands for bytes ``begins[i]`` up to ``ends[i]`` of the
    UTF-8 source. Of a character that is given as bytes, the last byte has the span and the
    others an empty one before it. Begin and end ids are not added. A null or empty text has
    no pieces; a row without an id or with a repeated id is encoded like any other; an empty
    table gives an empty result; other columns are ignored.
    """
    prepare(docs.sparkSession)
    data = _model_bytes(model_file)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))

    def run(batches):
        model = PieceModel.shared(data)
        for batch in batches:
            for part in slices(batch, pc.binary_length(batch["text"]), SLICE):
                counts, *flat = model.encode(strings(part["text"]).to_pylist())
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(f)) for f in flat]
                yield pa.record_batch([part["doc_id"], *lists], ["doc_id", "ids", "begins", "ends"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, begins array<int>, ends array<int>")


def decode(encoded: DataFrame, ids_col: str = "ids", model_file: str = MODEL_FILE, out: str = "text") -> DataFrame:
    """The other columns of ``encoded`` with the text that its ids stand for as column ``out``.

    A null list decodes to null and an empty one to the empty text. Control ids give no text,
    the unknown id its mark, bytes that form no character U+FFFD each. An id that the model
    does not have is an error. A column that is named like ``out`` is replaced.
    """
    prepare(encoded.sparkSession)
    data = _model_bytes(model_file)
    kept = [c for c in encoded.columns if c not in (ids_col, out)]
    rows = encoded.select(*kept, F.col(ids_col).cast("array<int>").alias(ids_col))

    def run(batches):
        model = PieceModel.shared(data)
        for batch in batches:
            for part in slices(batch, batch[ids_col].value_lengths(), SLICE):
                lists = part[ids_col]
                ids = lists.flatten().to_numpy(zero_copy_only=False)
                bounds = np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths().fill_null(0)))]).astype(np.int64)
                found = zip(model.decode(ids, bounds), lists.is_valid().to_pylist())
                text = pa.array([t if known else None for t, known in found], pa.binary()).cast(pa.string())
                yield pa.record_batch([*[part[c] for c in kept], text], [*kept, out])

    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept)
    return rows.mapInArrow(run, f"{schema}{', ' if kept else ''}`{out}` string")


def op13_sentence_pieces(spark, sf_dir: str) -> DataFrame:
    """With the bytes that the spans cover, which are all of the text's."""
    found = encode(read_table(spark, sf_dir, "documents"))
    digest = found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        # A text without pieces has no last one.
        F.coalesce(F.try_element_at("ends", F.lit(-1)) - F.try_element_at("begins", F.lit(1)), F.lit(0))
        .cast("long")
        .alias("covered_bytes"),
        "ids",
    )
    decoded = decode(digest, out="decoded")
    return decoded.select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"), "covered_bytes"
    )
