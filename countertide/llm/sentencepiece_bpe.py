"""SentencePiece BPE encoding and decoding in numpy (operator 3).

Texts are cut where no piece of the vocabulary can cross (before a run of spaces, around line ends). The distinct
words of a slice are merged together: all symbols lie in one flat array, and in each round every word finds its best
pair by a segmented minimum over pair ranks, merges all places of that pair from the left at once and is compacted;
a word without a pair leaves. A word merges one place at a time where a merge could make a pair that ranks no later
than the one at hand, so that the order of merges stays that of the one-at-a-time rule.

Defined results: a null or empty text gives the end id alone and decodes to the empty string; repeated rows are encoded
each; a very long text is encoded whole, in a slice of its own; columns that bear the name of a result are replaced, all others but
the text kept; an empty table gives an empty result. Characters outside the vocabulary become their UTF-8 byte pieces.
"""

from __future__ import annotations

import hashlib
import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countertide.llm.common import slices, table
from countertide.llm.registry import query

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # fixed values: kinds of pieces in the model format
_NO_PAIR = np.int32(2**31 - 1)
#: Bytes of encoded words that a task holds on to, and what one word costs besides its strings.
CACHED_BYTES = 96 << 20
_WORD_BYTES = 340
#: Letters of words that are merged at a time; each takes about a hundred bytes while it is merged.
MERGED_LETTERS = 1 << 17
#: Bytes of text that are split into words at a time; a single longer text is split alone.
SLICE_BYTES = 1 << 20


def _fields(data: bytes):
    """(number, value) of each field of a serialised message."""
    i = 0

    def varint() -> int:
        nonlocal i
        value = shift = 0
        while True:
            byte = data[i]
            i += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while i < len(data):
        number, wire = divmod(varint(), 8)
        if wire == 0:
            yield number, varint()
        elif wire == 2:
            size = varint()
            yield number, data[i : i + size]
            i += size
        else:
            size = 4 if wire == 5 else 8
            yield number, struct.unpack("<f" if wire == 5 else "<d", data[i : i + size])[0]
            i += size


class Model:
    """Tables of a BPE model: symbols, mergeable pairs in the order of their keys, ids. Small; it travels by broadcast."""

    def __init__(self, data: bytes):
        pieces, normalizer, trainer = [], {}, {}
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                pieces.append((piece[1].decode(), piece.get(2, 0.0), piece.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normalizer = dict(_fields(value))
        # The normaliser must do no more than mark spaces and put one in front.
        if trainer.get(3) != 2 or normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(3, 1) or not trainer.get(35):
            raise ValueError("only BPE models with byte fallback, identity normalisation and a leading space are read")
        if any(kind not in (NORMAL, UNKNOWN, CONTROL, BYTE) for _, _, kind in pieces):
            raise ValueError("user-defined and unused pieces are not read")
        self.end_id = trainer.get(42, 2)
        self.pieces = [p for p, _, _ in pieces]
        self.kinds = np.array([k for _, _, k in pieces], np.int8)
        self.byte_ids = np.zeros(256, np.int32)
        for i, (p, _, k) in enumerate(pieces):
            if k == BYTE:
                self.byte_ids[int(p[1:-1], 16)] = i
        normal = [(p, s, i) for i, (p, s, k) in enumerate(pieces) if k == NORMAL]
        self.symbols = [p for p, _, _ in normal]
        known = {p: n for n, p in enumerate(self.symbols)}
        for p in list(known):
            for c in p:
                if c not in known:  # a letter that only stands inside pieces can still begin a merge
                    known[c] = len(known)
                    self.symbols.append(c)
        self.ids = np.full(len(self.symbols), -1, np.int32)
        self.ids[: len(normal)] = [i for _, _, i in normal]
        scores = np.array([s for _, s, _ in normal])
        self.rank = np.full(len(self.symbols), _NO_PAIR, np.int32)
        self.rank[: len(normal)] = np.unique(-scores, return_inverse=True)[1]
        #: Symbols whose merge may make a pair of the same or a better rank.
        self.careful = np.zeros(len(self.symbols), bool)
        keys, made = [], []
        for n, (piece, _, _) in enumerate(normal):
            for cut in range(1, len(piece)):
                a, b = known.get(piece[:cut]), known.get(piece[cut:])
                if a is None or b is None:
                    continue
                keys.append(a * len(self.symbols) + b)
                made.append(n)
                for part in (a, b):
                    if len(self.symbols[part]) > 1 and self.rank[part] >= self.rank[n]:
                        self.careful[part] = True
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        self.pair_keys, self.pair_made = np.array(keys, np.int64)[order], np.array(made, np.int32)[order]
        self.letters = np.array([ord(s) for s in self.symbols if len(s) == 1], np.int64)
        self.letter_symbols = np.array([n for n, s in enumerate(self.symbols) if len(s) == 1], np.int32)
        if any(SPACE in p.lstrip(SPACE) for p in self.symbols):
            raise ValueError("a piece goes on after a word's end")
        line_end = all("\n" not in p or p == "\n" for p in self.symbols)
        #: Cuts a marked text where no piece crosses.
        self.cut = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n" if line_end else f"{SPACE}*[^{SPACE}]+|{SPACE}+")

    def letter_table(self) -> np.ndarray:
        """Symbol of each code point; minus one minus the code point where there is none."""
        out = -1 - np.arange(0x110000, dtype=np.int32)
        out[self.letters] = self.letter_symbols
        return out


def load_model(path: str) -> Model:
    """Read on the driver; executors need no file."""
    with open(path, "rb") as f:
        return Model(f.read())


def merge_words(words: list[str], model: Model, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Final symbols of all words in one array, and where each word's begin (one entry more)."""
    lengths = np.array([len(w) for w in words], np.int64)
    symbol = letters[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
    word = np.repeat(np.arange(len(words)), lengths)
    size = len(model.symbols)
    done_symbols, done_words = [], []
    while len(symbol):
        starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        segment = np.cumsum(np.concatenate([[0], word[1:] != word[:-1]]))
        made = np.full(len(symbol), -1, np.int32)
        pair = np.flatnonzero((word[:-1] == word[1:]) & (symbol[:-1] >= 0) & (symbol[1:] >= 0))
        key = symbol[pair].astype(np.int64) * size + symbol[pair + 1]
        at = np.minimum(np.searchsorted(model.pair_keys, key), len(model.pair_keys) - 1)
        hit = model.pair_keys[at] == key
        made[pair[hit]] = model.pair_made[at[hit]]
        rank = np.where(made >= 0, model.rank[made], _NO_PAIR)
        best = np.minimum.reduceat(rank, starts)
        over = (best == _NO_PAIR)[segment]
        if over.any():
            done_symbols.append(symbol[over])
            done_words.append(word[over])
        place = np.flatnonzero((rank == best[segment]) & ~over)
        if not len(place):
            break
        at_word = segment[place]
        first = np.concatenate([[True], at_word[1:] != at_word[:-1]])
        one_by_one = np.maximum.reduceat(model.careful[made[place]], np.flatnonzero(first))[np.cumsum(first) - 1]
        run = np.concatenate([[True], place[1:] != place[:-1] + 1])
        in_run = np.arange(len(place)) - np.flatnonzero(run)[np.cumsum(run) - 1]
        chosen = place[np.where(one_by_one, first, in_run % 2 == 0)]
        symbol[chosen] = made[chosen]
        stays = ~over
        stays[chosen + 1] = False
        symbol, word = symbol[stays], word[stays]
    if not done_symbols:
        return np.zeros(0, np.int32), np.zeros(len(words) + 1, np.int64)
    symbols, owners = np.concatenate(done_symbols), np.concatenate(done_words)
    order = np.argsort(owners, kind="stable")
    return symbols[order], np.searchsorted(owners[order], np.arange(len(words) + 1))


class Codec:
    """Encoder and decoder of one task, with the words met lately."""

    def __init__(self, model: Model):
        self.model, self.letters = model, model.letter_table()
        self.id_text = [str(i) for i in range(len(model.pieces))]
        #: Ids as text, the bytes they decode to, and the ids as packed 32-bit values.
        self.words: dict[str, tuple[str, bytes, bytes]] = {}
        #: Words met before these; of them, those met again move over.
        self.older: dict[str, tuple[str, bytes, bytes]] = {}
        self.held = 0

    def split(self, text: str | None) -> list[str]:
        return self.model.cut.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def learn(self, words: set[str]) -> None:
        """Encode words that are new; first forget those not met lately if many bytes are held."""
        if self.held > CACHED_BYTES // 2:
            self.older, self.words, self.held = self.words, {}, 0
        group: list[str] = []
        letters = 0
        for w in words:
            if w in self.words:
                continue
            if w in self.older:
                self._keep(w, self.older[w])
                continue
            if group and letters + len(w) > MERGED_LETTERS:
                self._encode_words(group)
                group, letters = [], 0
            group.append(w)
            letters += len(w)
        if group:
            self._encode_words(group)

    def _encode_words(self, new: list[str]) -> None:
        symbols, first = merge_words(new, self.model, self.letters)
        ids_of, byte_ids = self.model.ids, self.model.byte_ids
        for k, w in enumerate(new):
            ids: list[int] = []
            for s in symbols[first[k] : first[k + 1]].tolist():
                piece = int(ids_of[s]) if s >= 0 else -1
                if piece >= 0:
                    ids.append(piece)
                else:
                    letter = chr(-1 - s) if s < 0 else self.model.symbols[s]
                    ids.extend(int(byte_ids[b]) for b in letter.encode())
            entry = (" ".join([self.id_text[i] for i in ids]), self.decode_bytes(ids), np.array(ids, np.int32).tobytes())
            self._keep(w, entry)

    def _keep(self, word: str, entry: tuple[str, bytes, bytes]) -> None:
        self.words[word] = entry
        self.held += _WORD_BYTES + len(word) + sum(map(len, entry))

    def decode_bytes(self, ids) -> bytes:
        """UTF-8 of pieces, their space marks as spaces; runs of byte pieces that are no UTF-8 give U+FFFD for each byte."""
        out, run = [], []
        model = self.model
        for i in [*ids, None]:
            if i is not None and model.kinds[i] == BYTE:
                run.append(int(model.pieces[i][1:-1], 16))
                continue
            if run:
                out.append(_valid(bytes(run)))
                run = []
            if i is None or model.kinds[i] == CONTROL:
                continue
            out.append(" ⁇ ".encode() if model.kinds[i] == UNKNOWN else model.pieces[i].replace(SPACE, " ").encode())
        return b"".join(out)

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of each text, the end id last."""
        parts = [self.split(t) for t in texts]
        self.learn(set().union(*parts))
        end = np.array([self.model.end_id], np.int32).tobytes()
        return [np.frombuffer(b"".join([*(self.words[w][2] for w in p), end]), np.int32).tolist() for p in parts]

    def decode(self, ids) -> str:
        text = self.decode_bytes(ids).decode()
        return text[1:] if text.startswith(" ") else text


def _valid(data: bytes) -> bytes:
    try:
        data.decode()
        return data
    except UnicodeDecodeError as bad:
        return data[: bad.start] + "�".encode() + _valid(data[bad.start + 1 :])


def _each_slice(shared, make, names):
    """An Arrow function that runs ``make(codec, texts)`` on slices and puts its columns beside the kept ones."""

    def run(batches):
        codec = Codec(shared.value)
        for batch in batches:
            for part in slices(batch, "_text", SLICE_BYTES):
                kept = [part.column(n) for n in names]
                yield pa.RecordBatch.from_arrays([*kept, *make(codec, part.column("_text").to_pylist()).values()], names=[*names, *make.columns])

    return run


def _digests(codec: Codec, texts: list[str | None]) -> dict:
    parts = [codec.split(t) for t in texts]
    codec.learn(set().union(*parts))
    words, end = codec.words, str(codec.model.end_id)
    counts, ids_sha, text_sha = [], [], []
    for p in parts:
        known = [words[w] for w in p]
        ids = " ".join([k[0] for k in known] + [end])
        text = b"".join([k[1] for k in known])
        counts.append(ids.count(" ") + 1)
        ids_sha.append(hashlib.sha256(ids.encode()).hexdigest())
        text_sha.append(hashlib.sha256(text[1:] if text[:1] == b" " else text).hexdigest())
    return {"n_tokens": pa.array(counts, pa.int64()), "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(text_sha, pa.string())}


def _whole(codec: Codec, texts: list[str | None]) -> dict:
    parts = [codec.split(t) for t in texts]
    codec.learn(set().union(*parts))
    words, end = codec.words, np.array([codec.model.end_id], np.int32).tobytes()
    packed, texts, sizes = [], [], [0]
    for p in parts:
        known = [words[w] for w in p]
        packed += [k[2] for k in known] + [end]
        sizes.append(sum([len(k[2]) for k in known]) + len(end))
        text = b"".join([k[1] for k in known]).decode()  # a word ends with a letter, so words decode one by one
        texts.append(text[1:] if text[:1] == " " else text)
    ids = pa.array(np.frombuffer(b"".join(packed), np.int32))
    offsets = pa.array((np.cumsum(sizes) // 4).astype(np.int32))
    return {"ids": pa.ListArray.from_arrays(offsets, ids), "decoded": pa.array(texts, pa.string())}


_digests.columns = ("n_tokens", "ids_sha256", "decoded_sha256")
_whole.columns = ("ids", "decoded")


def _apply(docs: DataFrame, model_path: str, make, kinds: str, text: str) -> DataFrame:
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(load_model(model_path))
    kept = [c for c in docs.columns if c != text and c not in make.columns]
    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias("_text"))
    schema = source.drop("_text").schema
    for f in spark.createDataFrame([], kinds).schema.fields:
        schema = schema.add(f.name, f.dataType, True)
    return source.mapInArrow(_each_slice(shared, make, kept), schema)


def encode(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``ids`` (end id last) and ``decoded``, the text that the ids decode to."""
    return _apply(docs, model_path, _whole, "ids array<int>, decoded string", text)


def digests(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """``docs`` without the text, with the number of ids and SHA-256 of ids and decoded text: nothing long leaves a task."""
    return _apply(docs, model_path, _digests, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", text)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op3_sentencepiece")
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents").select("doc_id", "text"), default_model())
