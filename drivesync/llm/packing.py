"""Best-fit packing of tokenized documents by sums of squares.

Every document becomes its token ids and an end token, cut into pieces only
where it is longer than a sequence. Pieces are placed in order of falling
length; of all open bins that can take a piece it goes to the one after which
the sum, over residual gaps, of the squared numbers of open bins with that gap
is smallest (ties: smallest gap). A bin is opened only where none can take it.
"""

import json
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drivesync.llm.common import blocks, released, slices, stored, worker_state
from drivesync.session import settings

SEQUENCE_TOKENS = 4096
END_TOKEN = 1
# Pieces one task packs. The bins a group leaves part empty are a few of thousands.
GROUP_PIECES = 65_536
# Words, and half as many stems of words, a worker remembers: twice as many at most.
CACHE_WORDS = 400_000
# Characters of the texts whose words are looked up together.
TEXT_CHARS = 4 << 20
# Words the tokenizer is given at once: what it gives back is many times their size.
LEARN_WORDS = 4096
# What a worker is sent at once is held by it and by the executor, which has a
# buffer of up to twice the size.
SENT_BYTES = {"spark.sql.execution.arrow.maxBytesPerBatch": "3m"}
# What may follow the letters of a word: a run of its own for the tokenizer. No
# apostrophe (contractions), nothing that begins a special token.
TAIL = "!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~"
MOST_TAILS = 10_000
# How a tokenizer must split and fold text for words to be units.
UNITS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
FOLDS = ["NFC", "Replace", "Lowercase"]


class Recent:
    """What was looked up last (``now``): when it is full it becomes the older
    generation, from which what is still used is taken over."""

    def __init__(self, limit: int):
        self.limit, self.now, self.older = limit, {}, {}

    def refresh(self, keys, learn) -> dict:
        """Have all ``keys`` in ``now``, from the older generation or by ``learn(missing)``."""
        known = self.now
        missing = [k for k in keys if k not in known]
        if len(known) + len(missing) > self.limit:
            self.older, self.now, missing = known, {}, keys
        known, older, new = self.now, self.older, []
        for k in missing:
            value = older.get(k)
            if value is None:
                new.append(k)
            else:
                known[k] = value
        if new:
            learn(new)
        return known


class WordEncoder:
    """Token ids of texts, equal to ``Tokenizer.encode`` of the whole text.

    The tokenizer never joins across white space, and a run of letters is one
    unit of its own, so ids are found once a word and looked up again. That holds
    for tokenizers that split and fold as ``UNITS`` and ``FOLDS`` say; others are
    refused.
    """

    def __init__(self, path: str, remember: int = CACHE_WORDS):
        import os
        import re

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path) as file:
            spec = json.load(file)
        folds = [n.get("type") for n in (spec["normalizer"] or {}).get("normalizers", [])]
        units = [p.get("pattern", {}).get("Regex") for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])][:1]
        if folds != FOLDS or units != [UNITS]:
            raise ValueError(f"{path}: not a tokenizer of lower-cased words, see WordEncoder")
        ends = spec["model"].get("end_of_word_suffix")
        vocabulary = spec["model"]["vocab"]
        self.closing = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        if ends:
            self.closing[[i for token, i in vocabulary.items() if token.endswith(ends)]] = True
        spec |= {"normalizer": None, "added_tokens": [], "post_processor": None, "pre_tokenizer": {
            "type": "Sequence", "pretokenizers": [
                {"type": "WhitespaceSplit"},
                {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
            ]}}
        self.letters = Tokenizer.from_str(json.dumps(spec))
        # Letters that neither composition nor lower case turns into anything but letters.
        self.simple = re.compile("[A-Za-zÀ-ÖØ-öø-į]+")
        self.words, self.stems = Recent(remember), Recent(remember // 2)
        self.tails = {}

    def _learn_stems(self, stems: list[str]) -> None:
        for at in range(0, len(stems), LEARN_WORDS):
            self._learn_some(stems[at:at + LEARN_WORDS])

    def _learn_some(self, stems: list[str]) -> None:
        ids = np.array(self.letters.encode_batch_fast([" ".join(stems)], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = np.flatnonzero(self.closing[ids]) + 1
        known = self.stems.now
        if len(ends) == len(stems):
            raw, begin = ids.tobytes(), 0
            for stem, end in zip(stems, (4 * ends).tolist()):
                known[stem] = raw[begin:end]
                begin = end
        else:
            for stem in stems:
                known[stem] = self._encode(stem)

    def _encode(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn(self, words: list[str]) -> None:
        known, tails, simple = self.words.now, self.tails, self.simple.fullmatch
        plain, stems, other = [], [], []
        for word in words:
            stem = word.rstrip(TAIL)
            if stem.isalpha() and (stem.isascii() or simple(stem)):
                plain.append(word)
                stems.append(stem.lower())
            else:
                other.append(word)
        for at in range(0, len(other), LEARN_WORDS):
            some = other[at:at + LEARN_WORDS]
            for word, found in zip(some, self.whole.encode_batch_fast(some, add_special_tokens=False)):
                known[word] = np.array(found.ids, dtype="<u4").tobytes()
        ids = self.stems.refresh(dict.fromkeys(stems), lambda new: self._learn_stems(sorted(new)))
        if len(tails) > MOST_TAILS:
            tails.clear()
        for word, stem in zip(plain, stems):
            tail = word[len(stem):]
            if not tail:
                known[word] = ids[stem]
                continue
            if tail not in tails:
                tails[tail] = self._encode(tail)
            known[word] = ids[stem] + tails[tail]

    @staticmethod
    def _folded(text: str) -> str:
        """In lower case, if that changes no id: no composition, no special token."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
        return text if "<|" in text else text.lower()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of every text."""
        out = []
        for begin, end in blocks(texts, TEXT_CHARS):
            folded = [self._folded(t).replace("\n", " ") if t else "" for t in texts[begin:end]]
            words = pc.split_pattern(pa.array(folded, pa.large_string()), " ")
            coded = words.flatten().dictionary_encode()
            distinct = coded.dictionary.to_pylist()
            known = self.words.refresh(distinct, self._learn)
            ids = [known[word] for word in distinct]
            sizes = np.array([len(i) // 4 for i in ids], np.int64)
            first = np.cumsum(sizes) - sizes
            code = coded.indices.to_numpy()
            count = sizes[code]
            ends = np.concatenate([[0], np.cumsum(count)])
            # Where the ids of each word of the texts are among those of the distinct words.
            places = np.repeat(first[code] - ends[:-1], count)
            places += np.arange(ends[-1])
            flat = np.frombuffer(b"".join(ids), "<u4")[places]
            edges = ends[words.offsets.to_numpy()]
            out += [flat[a:b].tobytes() for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
            del words, coded, distinct, ids, code, count, ends, places, flat
            pa.default_memory_pool().release_unused()
        return out


def _encoder(path: str, remember: int = CACHE_WORDS) -> WordEncoder:
    known = worker_state().setdefault("encoders", {})
    if (path, remember) not in known:
        known[path, remember] = WordEncoder(path, remember)
    return known[path, remember]


def tokenize(
    docs: DataFrame, tokenizer: str, limit: int = SEQUENCE_TOKENS, end: int = END_TOKEN, ids: bool = False,
    remember: int = CACHE_WORDS,
) -> DataFrame:
    """Pieces of all documents: ``doc_id, piece, start, length, ids_crc32`` and,
    with ``ids``, the token ids. ``tokenizer`` is a file every executor has;
    ``remember`` trades a worker's memory for time, see ``CACHE_WORDS``."""
    key = docs.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("doc_id", key), T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ] + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * ids)

    def run(batches):
        encoder = _encoder(tokenizer, remember)
        close = np.array([end], dtype="<u4").tobytes()
        for batch in (part for whole in batches for part in slices(whole, 2500)):
            rows = ([], [], [], [], [], [])
            encoded = encoder.encode(batch.column("text").to_pylist())
            for at, raw in enumerate(encoded):
                raw += close
                for piece, begin in enumerate(range(0, len(raw), 4 * limit)):
                    part = raw[begin:begin + 4 * limit]
                    for column, value in zip(rows, (at, piece, begin // 4, len(part) // 4, zlib.crc32(part), part)):
                        column.append(value)
            columns = [batch.column("doc_id").take(pa.array(rows[0], pa.int32())), pa.array(rows[1], pa.int32())]
            columns += [pa.array(c, pa.int64()) for c in rows[2:5]]
            if ids:
                columns.append(pa.array([np.frombuffer(p, "<u4").astype(np.int32) for p in rows[5]], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(released(run), schema)


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece, placed by sums of squares in falling length."""
    open_bins = np.zeros(capacity + 1, dtype=np.int64)  # by residual gap; full ones don't count
    stacks: dict[int, list[int]] = {}
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    made, never = 0, np.iinfo(np.int64).max
    for at in np.argsort(-lengths, kind="stable"):
        size = int(lengths[at])
        gaps = open_bins[size:]
        change = np.where(gaps > 0, 2 * (open_bins[: len(gaps)] - gaps) + 2, never)
        if gaps[0]:
            change[0] -= 1
        best = int(change.argmin())
        if change[best] == never:
            chosen, gap, made = made, capacity, made + 1
        else:
            gap = best + size
            chosen = stacks[gap].pop()
            open_bins[gap] -= 1
        bins[at], offsets[at] = chosen, capacity - gap
        if gap > size:
            stacks.setdefault(gap - size, []).append(chosen)
            open_bins[gap - size] += 1
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = SEQUENCE_TOKENS, group: int = GROUP_PIECES) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length`` up to ``capacity``.

    Pieces are dealt evenly, whatever their keys, to tasks of about ``group``.
    """
    schema = T.StructType(pieces.schema.fields + [
        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches):
        table = pa.Table.from_batches(list(batches))
        if table.num_rows:
            bins, offsets = place(table.column("length").to_numpy(), capacity)
            bins += TaskContext.get().partitionId() << 32
            table = table.append_column("sequence_id", pa.array(bins)).append_column("offset", pa.array(offsets))
            yield from table.to_batches(max_chunksize=10_000)

    def whole(batches):
        batches = [b for b in batches if b.num_rows]
        return run(batches) if batches else iter(())

    tasks = max(1, -(-pieces.count() // group))
    return pieces.repartition(tasks).mapInArrow(released(whole), schema)


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = SEQUENCE_TOKENS, end: int = END_TOKEN, ids: bool = False,
    remember: int = CACHE_WORDS,
) -> DataFrame:
    """Pack ``documents`` into sequences of at most ``capacity`` tokens.

    Null text is an empty text, which is one end token. Null and repeated
    ``doc_id`` are packed row by row as any other; other columns are ignored;
    an empty table gives no rows. Of a long text every token is packed.
    """
    with settings(docs.sparkSession, SENT_BYTES):
        pieces = stored(tokenize(docs, tokenizer, capacity, end, ids, remember), "pieces")
    return pack(pieces, capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids``: the packed sequences, from rows that carry ``ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(parts["ids"]).alias("ids"))
