"""SentencePiece encoding with byte offsets, and decoding.

A text is normalised by the longest keys of the model's compiled character map (a double-array trie);
every byte of the result keeps the place of the source bytes that it came from. Pieces are merged by
their scores, best first, then leftmost; characters without a piece become bytes. Each piece is then
projected through the alignment to the bytes of the original text: spans follow each other and cover
the text. A character that becomes several bytes lies with the last of them, as in the library.

No piece holds a space mark after another character, so merges never cross the beginning of a word:
texts are cut into such units, and a unit met before isn't merged again. Where a model's pieces
do cross, a text is one unit.

Models are BPE with byte fallback and without user-defined or unused pieces; others are refused.

Cases: null texts are empty, and empty texts have no pieces; repeated rows repeat; texts of any
length are encoded whole; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
BAD = "�"
#: Fixed values of the model file: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, BYTE, BPE = 1, 2, 3, 6, 2
#: Units that are kept, characters of a unit that is, and of a part whose pairs wait in a heap.
CACHE, UNIT, MANY = 300_000, 64, 100
NEVER = 1 << 60


class CharMap:
    """A compiled character map: keys in a double-array trie, values as texts that end with a zero byte."""

    def __init__(self, blob: bytes):
        n = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob, "<u4", n // 4, 4).tolist() if n else []
        self.values = blob[4 + n :]
        self.first = {b for b in range(256) if self._step(self._offset(0), b) is not None} if self.units else set()

    def _offset(self, at: int) -> int:
        unit = self.units[at]
        return at ^ ((unit >> 10) << ((unit & 512) >> 6))

    def _step(self, at: int, byte: int) -> int | None:
        at ^= byte
        return at if at < len(self.units) and self.units[at] & 0x800000FF == byte else None

    def longest(self, data: bytes, begin: int) -> tuple[bytes, int] | None:
        """The value of the longest key at a place, and the key's bytes."""
        if not self.units:
            return None
        found, at = None, self._offset(0)
        for i in range(begin, len(data)):
            here = self._step(at, data[i])
            if here is None:
                break
            at = self._offset(here)
            if self.units[here] >> 8 & 1:
                found = self.units[at] & 0x7FFFFFFF, i + 1 - begin
        if found is None:
            return None
        return self.values[found[0] : self.values.index(0, found[0])], found[1]


class Model:
    """A model file, what it does to texts, and the units that it has met."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        kinds = {p.type for p in proto.pieces}
        if proto.trainer_spec.model_type != BPE or not proto.trainer_spec.byte_fallback or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE} or proto.denormalizer_spec.precompiled_charsmap:
            raise ValueError(f"{path} isn't a BPE model with byte fallback and plain pieces")
        spec = proto.normalizer_spec
        self.prefix, self.trim, self.escape, self.suffix = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces, proto.trainer_spec.treat_whitespace_as_suffix
        self.map = CharMap(spec.precompiled_charsmap)
        self.pieces = {p.piece: (i, p.score) for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        # What each id says: bytes, and whether it stands for a byte.
        self.says = [p.piece.replace(SPACE, " ").encode() if p.type == NORMAL else bytes([int(p.piece[3:5], 16)]) if p.type == BYTE else proto.trainer_spec.unk_surface.encode() if p.type == UNKNOWN else b"" for p in proto.pieces]
        self.is_byte = [p.type == BYTE for p in proto.pieces]
        self.spaced = {i for i, p in enumerate(proto.pieces) if p.type == NORMAL and p.piece.startswith(SPACE)}
        several = [p for p in self.pieces if len(p) > 1]
        inside = set("".join(several))
        alone = re.escape("".join(c for c in map(chr, range(32)) if c not in inside))
        crossed = any(re.search(f"[^{SPACE}]{SPACE}", p) for p in several)
        self.unit = re.compile(f"[^{alone}]+|[{alone}]" if crossed else f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+|[{alone}]")
        # Symbols are numbers: of pieces their ids, of all characters that aren't pieces numbers above them.
        self.n_pieces = len(proto.pieces)
        self.digits = list(map(str, range(self.n_pieces)))
        symbol = {p: i for p, (i, _) in self.pieces.items()}
        for c in inside - set(symbol):
            symbol[c] = self.n_pieces + ord(c)
        self.of_char = {ord(c): symbol[c] for c in symbol if len(c) == 1}
        self.width = np.array([len(p.piece.encode()) for p in proto.pieces], np.int64)
        place = {score: k for k, score in enumerate(sorted({x for _, x in self.pieces.values()}, reverse=True))}
        ways = sorted((symbol[p[:k]] << 32 | symbol[p[k:]], place[self.pieces[p][1]], self.pieces[p][0]) for p in several for k in range(1, len(p)) if p[:k] in symbol and p[k:] in symbol)
        self.pair, rank, made = (np.array(x, np.int64) for x in zip(*ways, strict=True))
        self.near = np.array(sorted({ord(p[i]) << 32 | ord(p[i + 1]) for p in several for i in range(len(p) - 1)}), np.int64)
        # A place after the last pair stands for two symbols that never merge.
        self.rank, self.made = np.append(rank, NEVER), np.append(made, -1)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.n = np.zeros(0, np.int64)  # tokens of each unit, and how often it was met
        self.hits = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)  # of all units after each other, and the bytes that end with them
        self.ends_with = np.zeros(0, np.int64)

    def shrink(self) -> None:
        """Keeps the half of the units that were met most often."""
        names = np.array(list(self.known), object)
        at = np.fromiter(self.known.values(), np.int64, len(names))
        best = np.sort(np.argsort(-self.hits[at], kind="stable")[: len(names) // 2])
        names, at = names[best].tolist(), at[best]
        begins, n = (np.cumsum(self.n) - self.n)[at], self.n[at]
        gather = np.repeat(begins - (np.cumsum(n) - n), n) + np.arange(n.sum())
        self.known = {u: k for k, u in enumerate(names)}
        self.n, self.hits, self.ids, self.ends_with = n, np.zeros(len(n), np.int64), self.ids[gather], self.ends_with[gather]

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes and its end the place in the source's bytes."""
        data = text.encode("utf-8", "surrogatepass")
        if not data:
            return "", np.zeros(1, np.int64)
        if not self.map.units and not self.trim and self.prefix and self.escape and not self.suffix:
            raw = np.frombuffer(data, np.uint8)
            widths = np.where(raw == 32, 3, 1)
            return SPACE + text.replace(" ", SPACE), np.concatenate((np.zeros(3, np.int64), np.repeat(np.arange(len(raw)), widths), np.array([len(raw)])))
        return self._walk(data)

    def _prefix(self, data: bytes, at: int) -> tuple[bytes, int]:
        found = self.map.longest(data, at) if data[at] in self.map.first else None
        if found:
            return found
        lead = data[at]
        n = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return data[at : at + n], n

    def _walk(self, data: bytes) -> tuple[str, np.ndarray]:
        """Normalisation key by key, with all of the model's rules about spaces."""
        space = SPACE.encode() if self.escape else b" "
        out, align, at = bytearray(), [], 0
        while self.trim and at < len(data):
            said, n = self._prefix(data, at)
            if said != b" ":
                break
            at += n
        if at == len(data):
            return "", np.zeros(1, np.int64)

        def put(said: bytes) -> None:
            out.extend(said)
            align.extend([at] * len(said))

        if self.prefix and not self.suffix:
            put(space)
        spaced = self.trim
        while at < len(data):
            said, n = self._prefix(data, at)
            if spaced:
                said = said.lstrip(b" ")
            if said:
                put(said.replace(b" ", space))
                spaced = self.trim and said.endswith(b" ")
            at += n
        while self.trim and out.endswith(space):
            at = align[len(out) - len(space)]
            del out[len(out) - len(space) :], align[len(align) - len(space) :]
        if self.prefix and self.suffix:
            put(space)
        return out.decode("utf-8", "surrogatepass"), np.array([*align, at], np.int64)

    def _look(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Places of pairs among those that merge."""
        keys = left << 32 | right
        at = np.searchsorted(self.pair, keys)
        return np.where(self.pair[np.minimum(at, len(self.pair) - 1)] == keys, at, len(self.pair))

    def merged(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all units after each other, merged by score, then leftmost; and the character that each begins with.

        A round merges the best pair of every part, which is a run of characters that pieces can hold next to each other.
        """
        codes = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        distinct, inverse = np.unique(codes, return_inverse=True)
        own = np.array([self.of_char.get(int(c), self.n_pieces + int(c)) for c in distinct], np.int64)[inverse]
        unit = np.repeat(np.arange(len(units)), [len(u) for u in units])
        place = np.arange(len(own))
        found = np.append(np.where(unit[:-1] == unit[1:], self._look(own[:-1], own[1:]), len(self.pair)), len(self.pair))
        # No merge reaches over two characters that are next to each other in no piece.
        cut = np.append((unit[:-1] != unit[1:]) | ~np.isin(codes[:-1] << 32 | codes[1:], self.near), True)
        part = np.concatenate((np.zeros(1, np.int64), np.cumsum(cut[:-1])))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        sizes = np.bincount(part)
        for k in np.flatnonzero(sizes > MANY).tolist():
            here = part == k
            done.append(self._heaped(own[here].tolist(), place[here]))
        here = sizes[part] <= MANY
        own, place, found, part = own[here], place[here], found[here], part[here]
        while len(own):
            begins = np.flatnonzero(np.diff(part, prepend=-1))
            length = np.diff(np.append(begins, len(part)))
            rank = self.rank[found]
            least = np.minimum.reduceat(rank, begins)
            open_ = np.repeat(least < NEVER, length)
            if not open_.all():
                done.append((own[~open_], place[~open_]))
                own, place, found, part, rank = own[open_], place[open_], found[open_], part[open_], rank[open_]
                length, least = length[least < NEVER], least[least < NEVER]
                if not len(own):
                    break
            best = np.flatnonzero(rank == np.repeat(least, length))
            best = best[np.diff(part[best], prepend=-1) != 0]  # the leftmost of each part
            own[best] = self.made[found[best]]
            kept = np.ones(len(own), bool)
            kept[best + 1] = False
            now = best - np.arange(len(best))  # places after earlier parts' losses
            own, place, part = own[kept], place[kept], part[kept]
            found[best] = found[best + 1]
            found = found[kept]
            for left in (now - 1, now):
                fit = (left >= 0) & (left + 1 < len(own))
                left = left[fit]
                left = left[part[left] == part[left + 1]]
                found[left] = self._look(own[left], own[left + 1])
            last = now[(now + 1 >= len(own)) | (part[np.minimum(now + 1, len(own) - 1)] != part[now])]
            found[last] = len(self.pair)
        if not done:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        own, place = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(place, kind="stable")
        return own[order], place[order]

    def _heaped(self, own: list[int], place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for one long part, whose pairs wait in a heap."""

        def look(a: int, b: int) -> int:
            k = int(np.searchsorted(self.pair, a << 32 | b))
            return k if k < len(self.pair) and self.pair[k] == a << 32 | b else -1

        before, after = list(range(-1, len(own) - 1)), [*range(1, len(own)), -1]
        gone = np.zeros(len(own), bool)
        first = self._look(np.array(own[:-1]), np.array(own[1:])).tolist()
        waiting = [(int(self.rank[k]), i, k) for i, k in enumerate(first) if k < len(self.pair)]
        heapq.heapify(waiting)
        while waiting:
            _, a, k = heapq.heappop(waiting)
            b = after[a]
            if gone[a] or b < 0 or own[a] << 32 | own[b] != self.pair[k]:
                continue
            own[a] = int(self.made[k])
            gone[b] = True
            after[a] = after[b]
            if after[a] >= 0:
                before[after[a]] = a
            for x in (a, before[a]):
                if x >= 0 and after[x] >= 0 and (k := look(own[x], own[after[x]])) >= 0:
                    heapq.heappush(waiting, (int(self.rank[k]), x, k))
        return np.array(own, np.int64)[~gone], place[~gone]

    def add(self, units: list[str]) -> None:
        """Keeps the pieces of units that are new."""
        own, place = self.merged(units)
        whole = own < self.n_pieces
        width = np.where(whole, self.width[np.minimum(own, self.n_pieces - 1)], 1)
        code = own - self.n_pieces
        width[~whole] = np.searchsorted([0x80, 0x800, 0x10000], code[~whole], "right") + 1
        # A character without a piece becomes its bytes, of which the last one holds it.
        times = np.where(whole, 1, width)
        at = np.repeat(np.arange(len(own)), times)
        ids, ends_with = own[at], np.zeros(len(at), np.int64)
        ends_with[np.cumsum(times) - 1] = width
        starts = np.cumsum(times) - times
        for k in np.flatnonzero(~whole).tolist():
            raw = chr(int(code[k])).encode("utf-8", "surrogatepass")
            ids[starts[k] : starts[k] + len(raw)] = [self.bytes[b] for b in raw]
        ends = np.cumsum([len(u) for u in units])
        tokens = np.concatenate((np.zeros(1, np.int64), np.cumsum(times)))[np.searchsorted(place, ends)]
        for k, u in enumerate(units, len(self.n)):
            self.known[u] = k
        self.n = np.append(self.n, np.diff(tokens, prepend=0))
        self.hits = np.append(self.hits, np.zeros(len(units), np.int64))
        self.ids, self.ends_with = np.append(self.ids, ids.astype(np.int32)), np.append(self.ends_with, ends_with)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of all texts after each other ids, begins and ends in the source's bytes; and where each text's begin (one more than texts)."""
        if len(self.known) > CACHE or len(self.ids) > 8 * CACHE:
            self.shrink()
        units: list[str] = []
        per_text, aligned = [0], []
        for text in texts:
            normal, align = self.normalise(text)
            aligned.append(align)
            units.extend(self.unit.findall(normal))
            per_text.append(len(units))
        found = list(map(self.known.get, units))
        if None in found:
            new = list(dict.fromkeys(u for u, k in zip(units, found, strict=True) if k is None))
            long = [u for u in new if len(u) > UNIT]
            self.add(new)
            found = list(map(self.known.__getitem__, units))
            for u in long:
                del self.known[u]
        at = np.array(found, np.int64)
        self.hits += np.bincount(at, minlength=len(self.n))
        n = self.n[at]
        ends_at = np.concatenate((np.zeros(1, np.int64), np.cumsum(n)))
        gather = np.repeat((np.cumsum(self.n) - self.n)[at] - ends_at[:-1], n) + np.arange(ends_at[-1])
        per_token = ends_at[per_text]
        # Places among all alignments, which hold one more a text than bytes.
        sizes = self.ends_with[gather]
        ends = np.cumsum(sizes) + np.repeat(np.arange(len(texts)), np.diff(per_token))
        align = np.concatenate(aligned) if aligned else np.zeros(0, np.int64)
        return self.ids[gather], align[ends - sizes], align[ends], per_token

    def decode(self, ids: list[int]) -> str:
        """What ids say: without the first space mark, and with a sign in place of each byte that is no character."""
        if self.prefix or self.trim:
            ids = self._opened(ids)
        raw = b"".join(map(self.says.__getitem__, ids))
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return self._told(ids)

    def _opened(self, ids: list[int]) -> list:
        """ids without the space mark that opens the text, put as an id that says the rest of its piece."""
        for k, i in enumerate(ids):
            if self.is_byte[i]:
                return ids
            if i in self.spaced:
                rest = self.says[i].lstrip(b" ") if self.trim else self.says[i][1:]
                return [*ids[:k], *([self._rest(rest)] if rest else []), *ids[k + 1 :]]
            if self.says[i]:
                return ids
        return ids

    def _rest(self, rest: bytes) -> int:
        if not hasattr(self, "rests"):
            self.rests: dict[bytes, int] = {}
        if rest not in self.rests:
            self.rests[rest] = len(self.says)
            self.says.append(rest)
            self.is_byte.append(False)
        return self.rests[rest]

    def _told(self, ids: list[int]) -> str:
        """As decode, for runs of bytes that aren't UTF-8."""
        out, run = [], bytearray()

        def close() -> None:
            at = 0
            while at < len(run):
                for n in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[at : at + n]).decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append(BAD)
                    n = 1
                at += n
            run.clear()

        for i in ids:
            if self.is_byte[i]:
                run.extend(self.says[i])
            else:
                close()
                out.append(self.says[i].decode())
        close()
        return "".join(out)


@lru_cache(maxsize=2)
def model(path: str | None = None) -> Model:
    """path: where every worker finds the model; None is the installed one."""
    import public_tokenizers

    return Model(path or public_tokenizers.path(MODEL))


#: Rows, and characters but for one text's, that are encoded at once.
ROWS, CHARACTERS = 400, 1_000_000


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str]]]:
    """Runs of a batch's texts, and where they begin."""
    for begin in range(0, batch.num_rows, ROWS):
        held: list[str] = []
        first, size = begin, 0
        for i, text in enumerate(batch.column("text").slice(begin, ROWS).to_pylist(), begin):
            if held and size + len(text or "") > CHARACTERS:
                yield first, held
                held, first, size = [], i, 0
            held.append(text or "")
            size += len(text or "")
        yield first, held


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids, begins, ends of every text: pieces with their spans in the bytes of the original text."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for batch in batches:
            for begin, texts in _texts(batch):
                ids, begins, ends, at = own.encode(texts)
                offsets = pa.array(at.astype(np.int32))
                lists = (pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (ids, begins, ends))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(begin, len(texts)), *lists], names=["doc_id", "ids", "begins", "ends"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>, begins array<int>, ends array<int>")


def decoded(pieces: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and text of rows doc_id, ids."""
    kind = pieces.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for batch in batches:
            texts = [own.decode(ids) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return pieces.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, and n_bytes that the pieces' spans cover, of every text.

    Texts are encoded, and their ids decoded, in one task: arrays of all ids and spans don't travel.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for batch in batches:
            for begin, texts in _texts(batch):
                ids, begins, ends, at = own.encode(texts)
                spans = np.concatenate((np.zeros(1, np.int64), np.cumsum(ends - begins)))
                of_ids, of_text = [], []
                for a, b in zip(at, at[1:], strict=False):
                    own_ids = ids[a:b].tolist()
                    of_ids.append(hashlib.sha256(",".join(map(own.digits.__getitem__, own_ids)).encode()).hexdigest())
                    of_text.append(hashlib.sha256(own.decode(own_ids).encode("utf-8", "surrogatepass")).hexdigest())
                columns = [batch.column("doc_id").slice(begin, len(texts)), pa.array(np.diff(at)), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string()), pa.array(spans[at[1:]] - spans[at[:-1]])]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes long")
