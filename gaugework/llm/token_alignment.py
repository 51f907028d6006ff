"""Cross-tokenizer alignment by interval coalescing.

Both tokenizers cut the same bytes. All A and B tokens of a run of documents are sorted by start together; the running maximum
of their ends tells where a start reaches everything before it, and there a new group begins. Within a group, each B token is
expanded to the A tokens it overlaps. How often an id pair is linked corpus-wide is summed over runs, joined to the
runs' dictionaries of pairs, and brought back to the documents.

A is a byte-level BPE vocabulary, B a piece model with byte fallback. The vocabulary files are read where the job is planned and
shipped to the tasks, some megabytes whatever the input. The byte-level vocabulary numbers its entries in order of
their merges (checked when loaded), so a rank encoder over the same entries gives the same ids.

Defined results: a null or empty text, and one whose tokens do not spell a blank and the text, has no tokens: zeros, and an empty
groups_sha256. Repeated rows and ids are documents of their own and count as such. An empty table gives an empty result. Other columns
play no role. A text is held whole by one task, with some 100 bytes of memory for each of its bytes.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugework.llm.frames import stored, text_runs
from gaugework.llm.runs import counted, pack, run_ids, unpack

# Fixed value: how the byte-level vocabulary cuts a text into words before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ALIGN_BYTES = 1 << 20  # text in a run; a task holds some 100 times as much while it aligns one
WHITE_RUN = 50_000  # white space of this length goes to the slower encoder: the other's pattern search gives up somewhere above


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes for themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def byte_level_entries(file: bytes) -> dict[bytes, int]:
    """Bytes of each ordinary entry of a byte-level BPE file, with its id."""
    spec, letters = json.loads(file), byte_letters()
    special = {t["content"] for t in spec.get("added_tokens", ())}
    ids = spec["model"]["vocab"]
    for i, merge in enumerate(spec["model"]["merges"]):
        if ids["".join(merge.split(" ") if isinstance(merge, str) else merge)] != 256 + i:
            raise ValueError("entries are not numbered in order of their merges")
    return {bytes(letters[c] for c in entry): i for entry, i in ids.items() if entry not in special}


class Encoders:
    """Both tokenizers, made once per task from the bytes of their files."""

    def __init__(self, a_file: bytes, b_file: bytes):
        import sentencepiece
        import tiktoken

        entries = byte_level_entries(a_file)
        self._file = a_file
        self._a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=entries, special_tokens={})
        self._b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.a_bytes[i] = entry
        self.b_bytes = []
        for i in range(self._b.get_piece_size()):
            piece = self._b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self._b.is_byte(i) else piece.replace("▁", " ").encode())
        self.digits = decimals(max(len(self.a_bytes), len(self.b_bytes)))
        self.widths = [np.array([len(x) for x in side], np.int64) for side in (self.a_bytes, self.b_bytes)]

    def _whole(self, text: str) -> list[int]:
        from tokenizers import Tokenizer

        t = Tokenizer.from_str(self._file.decode())
        t.encode_special_tokens = True
        return t.encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """A and B ids of each text that both spell; none of either for the others."""
        a, b = [], []
        for text, of_b in zip(texts, self._b.encode(texts, num_threads=1)):
            whole = " " + text
            of_a = [] if not text else self._whole(whole) if long_white(text) else self._a.encode_ordinary(whole)
            spelt = whole.encode()
            if not text or b"".join(map(self.a_bytes.__getitem__, of_a)) != spelt or b"".join(map(self.b_bytes.__getitem__, of_b)) != spelt:
                of_a, of_b = [], []
            a.append(np.array(of_a, np.int64))
            b.append(np.array(of_b, np.int64))
        return a, b


_LOADED: dict[str, Encoders] = {}


def encoders_of(a_file: bytes, b_file: bytes) -> Encoders:
    """The tokenizers of two files, kept by the worker for its next task."""
    key = hashlib.sha256(a_file + b_file).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Encoders(a_file, b_file)
    return _LOADED[key]


def long_white(text: str) -> bool:
    return len(text) >= WHITE_RUN and max(map(len, "".join(" " if c.isspace() else "x" for c in text).split("x"))) >= WHITE_RUN


def coalesced(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Group of each A and each B interval, and the number of groups; a group ends where no interval reaches further."""
    starts, ends = np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end])
    side = np.repeat([0, 1], [len(a_start), len(b_start)])
    order = np.lexsort((side, starts))
    if not len(order):
        return order, order, 0
    reached = np.maximum.accumulate(ends[order])
    opens = np.concatenate([[0], starts[order][1:] >= reached[:-1]])
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(opens)
    return group[:len(a_start)], group[len(a_start):], int(group[order[-1]]) + 1


def overlaps(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the A and B intervals that overlap, for sides whose starts and ends both increase."""
    low, high = np.searchsorted(a_end, b_start, "right"), np.searchsorted(a_start, b_end, "left")
    n = np.maximum(high - low, 0)
    b = np.repeat(np.arange(len(b_start)), n)
    return np.arange(len(b)) + np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]) if len(n) else low, n), b


def decimals(below: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0 .. below - 1 from the left, one row each with a free cell behind, and how many they are."""
    texts = [str(i).encode() for i in range(below)]
    most = max(map(len, texts), default=0) + 1
    return np.frombuffer(b"".join(t.ljust(most) for t in texts), np.uint8).reshape(below, most), np.array([len(t) for t in texts], np.int64)


def spelt_groups(a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray, groups: int, digits: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """`a1,a2|b1;` for each group as one run of bytes, and where the text of each group begins in it."""
    n_a, n_b = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
    tokens = np.empty(len(a) + len(b), np.int64)
    mark = np.empty(len(tokens), np.uint8)
    before_a, before_b = np.cumsum(n_a), np.cumsum(n_b)
    at_a = np.arange(len(a)) + (before_b - n_b)[a_group]
    at_b = np.arange(len(b)) + before_a[b_group]
    tokens[at_a], tokens[at_b] = a, b
    last_a = np.append(np.diff(a_group) != 0, True)[:len(a)]
    last_b = np.append(np.diff(b_group) != 0, True)[:len(b)]
    mark[at_a], mark[at_b] = np.where(last_a, ord("|"), ord(",")), np.where(last_b, ord(";"), ord(","))
    cells, width = digits[0][tokens], digits[1][tokens]
    cells[np.arange(len(tokens)), width] = mark
    ends = np.concatenate([[0], np.cumsum(width + 1)])
    first = np.concatenate([[0], np.cumsum(n_a + n_b)])
    return cells[np.arange(cells.shape[1]) <= width[:, None]], ends[first]


def aligned(texts: list[str], encoders: Encoders) -> dict:
    """Token, group and link figures of each text, and its links as (document, A id, B id)."""
    ids = encoders.encode(texts)
    counts = [np.array([len(doc) for doc in side], np.int64) for side in ids]
    flat = [np.concatenate([*side, np.zeros(0, np.int64)]) for side in ids]
    ends = [np.cumsum(width[x]) for width, x in zip(encoders.widths, flat)]  # one line of bytes for all texts
    starts = [np.concatenate([[0], e[:-1]]) if len(e) else e for e in ends]
    a_group, b_group, groups = coalesced(starts[0], ends[0], starts[1], ends[1])
    left, right = overlaps(starts[0], ends[0], starts[1], ends[1])
    upto_a, upto_b = np.cumsum(counts[0]), np.cumsum(counts[1])
    doc_of_b = np.repeat(np.arange(len(texts)), counts[1])
    spelt, at = spelt_groups(flat[0], flat[1], a_group, b_group, groups, encoders.digits)
    # No group spans two texts: both sides end with each of them.
    first = np.concatenate([[0], a_group[upto_a[:-1].clip(max=max(len(a_group) - 1, 0))]]) if groups else np.zeros(len(texts), np.int64)
    first[np.concatenate([[0], upto_a[:-1]]) >= upto_a[-1]] = groups
    after = np.append(first[1:], groups)
    digest = [hashlib.sha256(spelt[at[x]:at[y] - 1]).hexdigest() if y > x else "" for x, y in zip(first, after)]
    return {
        "n_a": counts[0], "n_b": counts[1], "n_groups": after - first, "n_links": np.bincount(doc_of_b[right], minlength=len(texts)),
        "groups_sha256": digest, "doc": doc_of_b[right], "a": flat[0][left], "b": flat[1][right],
    }


FIGURES = ("n_a", "n_b", "n_groups", "n_links")
RUN_SCHEMA = "run long, pos long, pair long, n long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary"


def runs(docs: DataFrame, a_file: bytes, b_file: bytes, run_bytes: int = ALIGN_BYTES) -> DataFrame:
    """Rows of two kinds: a pair of a run's dictionary (run, pos, pair, n), or a document of the run with its figures and links."""
    spark = docs.sparkSession
    files = spark.sparkContext.broadcast((a_file, b_file))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders, numbers, names = None, run_ids(), [c.split()[0] for c in RUN_SCHEMA.split(", ")]
        types = [pa.string() if n == "groups_sha256" else pa.binary() if n == "links" else pa.int64() for n in names]

        def rows(many: int, **given) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(given[k], t) if k in given else pa.nulls(many, t) for k, t in zip(names, types)], names=names)

        for batch in batches:
            encoders = encoders or encoders_of(*files.value)
            for x, y, _, _ in text_runs(batch.column(1), run_bytes):
                texts = [t or "" for t in batch.column(1).slice(x, y - x).to_pylist()]
                found, run = aligned(texts, encoders), next(numbers)
                pairs, code = np.unique(found["a"] << 32 | found["b"], return_inverse=True)
                at, n, offsets = counted(found["doc"], code, len(texts))
                yield rows(len(pairs), run=np.full(len(pairs), run), pos=np.arange(len(pairs)), pair=pairs, n=np.bincount(code, minlength=len(pairs)))
                links = [pack(at[p:q], n[p:q]) for p, q in zip(offsets[:-1], offsets[1:])]
                figures = {k: found[k] for k in FIGURES}
                yield rows(y - x, run=np.full(y - x, run), doc_id=batch.column(0).slice(x, y - x), groups_sha256=found["groups_sha256"], links=links, **figures)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(work, RUN_SCHEMA)


def pair_counts(listed: DataFrame) -> DataFrame:
    """(pair, count, best): links of each id pair corpus-wide, and whether no other A id has more links with its B id."""
    counts = listed.groupBy("pair").agg(F.sum("n").alias("count"))
    most = F.max("count").over(Window.partitionBy((F.col("pair").bitwiseAND(0xFFFFFFFF))))
    return counts.select("pair", "count", (F.col("count") == most).alias("best"))


def align(docs: DataFrame, a_file: bytes, b_file: bytes, run_bytes: int = ALIGN_BYTES) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row of `docs` (doc_id, text)."""
    every = stored(runs(docs, a_file, b_file, run_bytes), "aligned")
    listed = every.where("pair is not null").select("run", "pos", "pair", "n")
    known = listed.drop("n").join(stored(pair_counts(listed), "pairs"), "pair").select(F.col("run").alias("of_run"), "pos", "count", F.col("best").cast("int").alias("best"))
    of_docs = every.where("links is not null").select("run", "doc_id", *FIGURES, "groups_sha256", "links")

    def back(left: pa.Table, right: pa.Table) -> pa.Table:
        row, at, n = unpack(left.column("links").combine_chunks())
        order = np.argsort(right.column("pos").to_numpy())
        count, best = (right.column(c).to_numpy()[order] for c in ("count", "best"))
        edges = np.searchsorted(row, np.arange(left.num_rows + 1))
        total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[edges])  # noqa: E731  whole numbers, never through floats
        sums = {"n_best": total(n * best[at]), "count_sum": total(n * count[at])}
        named = {c: left.column(c) for c in ("doc_id", *FIGURES)} | {k: pa.array(v, pa.int64()) for k, v in sums.items()}
        return pa.table(named | {"groups_sha256": left.column("groups_sha256")})

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return of_docs.groupBy("run").cogroup(known.groupBy("of_run")).applyInArrow(back, schema)
