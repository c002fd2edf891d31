"""Alignment of the tokens of two tokenizers over the bytes they cover.

Each tokenizer cuts the same bytes. Places where a token of both ends are found
by a galloping intersection of the two lists of ends: those of the shorter list
are looked for in the longer by doubling steps, then by binary searches.
Common ends cut both token lists into groups; two tokens of one group are linked.

At scale: a document is tokenised once and written with its linked id pairs, each
with how often it is linked. Document counts of the pairs are one aggregation
with a combine in each task. At most ``FREQUENT`` pairs with the largest counts
are broadcast to score the documents; links of all other pairs, which are in few
documents each, go through a plain join.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statewise.llm.common import map_batches
from statewise.workspace import settle, settle_result

TOKENIZERS = "/opt/tokenizers"
BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"
#: Pairs that are broadcast: code, count and a flag, 17 bytes each.
FREQUENT = 500_000
#: Links that are listed at once.
BLOCK = 2**20
#: Tokens whose bytes are joined at once.
JOINED = 2**18
#: Ends of the shorter list that are looked for at a time.
DRIVEN = 256
#: Of the largest token id.
DIGITS = 7

# The word pattern of the byte-level tokenizer.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Characters whose class (letter, digit, space) is the same in every version of Unicode.
SETTLED = re.compile("[\x00-ɏ‐-‧]*")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in set(plain)]
    letters = {chr(byte): byte for byte in plain}
    return letters | {chr(256 + place): byte for place, byte in enumerate(others)}


class Strings:
    """Numbered byte strings, laid end to end so that many are joined at once."""

    def __init__(self, strings: Sequence[bytes]):
        self._flat = np.frombuffer(b"".join(strings), dtype=np.uint8)
        self.sizes = np.array([len(string) for string in strings], dtype=np.int64)
        self._starts = np.cumsum(self.sizes) - self.sizes

    def joined(self, numbers: np.ndarray) -> bytes:
        parts = []
        for begin in range(0, len(numbers), JOINED):
            taken = numbers[begin : begin + JOINED]
            sizes = self.sizes[taken]
            at = np.repeat(self._starts[taken] - (np.cumsum(sizes) - sizes), sizes)
            at += np.arange(len(at))
            parts.append(self._flat[at].tobytes())
        return parts[0] if len(parts) == 1 else b"".join(parts)


class ByteBpe:
    """A byte-level tokenizer from its JSON text."""

    def __init__(self, content: bytes):
        self.content = content
        described = json.loads(content)
        letters = _byte_letters()
        special = {token["content"] for token in described["added_tokens"]}
        vocabulary = described["model"]["vocab"]
        self.pieces = [b""] * (max(vocabulary.values()) + 1)
        for piece, number in vocabulary.items():
            if piece not in special:
                self.pieces[number] = bytes(letters[letter] for letter in piece)
        self._fast = self._exact = None

    def encode(self, text: str) -> np.ndarray:
        """Ids of ``text``, strings of special tokens being plain text.

        In such a vocabulary ids rise in the order of the merges, so ranks give the
        same tokens as the list of merges; where Unicode versions could part words
        otherwise, the tokenizer's own library decides.
        """
        if SETTLED.fullmatch(text):
            if self._fast is None:
                import tiktoken

                ranks = {piece: number for number, piece in enumerate(self.pieces) if piece}
                self._fast = tiktoken.Encoding(
                    "byte_bpe", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={}
                )
            return self._fast.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
        if self._exact is None:
            from tokenizers import Tokenizer

            self._exact = Tokenizer.from_str(self.content.decode("utf-8"))
            self._exact.encode_special_tokens = True
        return np.array(self._exact.encode(text, add_special_tokens=False).ids, dtype=np.int64)


class PieceBpe:
    """A piece tokenizer from its model file; it puts a space before the text."""

    def __init__(self, content: bytes):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_proto=content)
        self.pieces = [self._bytes(number) for number in range(self._model.get_piece_size())]

    def _bytes(self, number: int) -> bytes:
        piece = self._model.id_to_piece(number)
        if self._model.is_byte(number):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode("utf-8")

    def encode(self, text: str) -> np.ndarray:
        return np.array(self._model.encode(text, num_threads=1), dtype=np.int64)


@lru_cache(maxsize=2)
def _tokenizers(a: bytes, b: bytes):
    """Both tokenizers with the bytes of their ids, and the decimal forms of those,
    first before a comma, then before the end of their side of a group. The forms
    are of one width, filled up with NUL."""
    made = []
    for tokenizer, end in ((ByteBpe(a), b"|"), (PieceBpe(b), b";")):
        numbers = range(len(tokenizer.pieces))
        names = [str(number).encode() + mark for mark in (b",", end) for number in numbers]
        made.append((tokenizer, Strings(tokenizer.pieces), np.array(names, dtype=f"S{DIGITS + 1}")))
    return made


def common_ends(a: Sequence[int], b: Sequence[int]) -> tuple[list[int], list[int]]:
    """Places in ``a`` and in ``b`` (both rising) that hold the same value."""
    in_a, in_b = _common_places(np.asarray(a, dtype=np.int64), np.asarray(b, dtype=np.int64))
    return in_a.tolist(), in_b.tolist()


def _common_places(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``common_ends`` of arrays.

    The shorter list is taken ``DRIVEN`` values at a time. Doubling steps from the
    last place found lead to one that is not before the last of them; between the
    two each value is found by a binary search.
    """
    if len(a) > len(b):
        in_b, in_a = _common_places(b, a)
        return in_a, in_b
    places = np.empty(len(a), dtype=np.int64)
    if not len(a):
        return places, places
    low = 0
    for begin in range(0, len(a), DRIVEN):
        wanted = a[begin : begin + DRIVEN]
        last, high, step = wanted[-1], low, 1
        while high < len(b) and b[high] < last:
            high += step
            step *= 2
        places[begin : begin + DRIVEN] = low + np.searchsorted(b[low : high + 1], wanted)
        low = int(places[begin + len(wanted) - 1])
    in_a = np.flatnonzero(b[np.minimum(places, len(b) - 1)] == a)
    return in_a, places[in_a]


def linked_pairs(
    a: np.ndarray, b: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray, n_b_ids: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (codes, times) of the linked id pairs; no code is in two blocks.

    ``a_sizes`` and ``b_sizes`` are the numbers of tokens of each group. The code
    of a pair is its A id times ``n_b_ids`` plus its B id. Tokens that repeat in a
    group are counted first, and A ids are taken in blocks, so a group of any size
    needs no list of all its links.
    """
    groups = np.arange(len(a_sizes))
    a_group, b_group = np.repeat(groups, a_sizes), np.repeat(groups, b_sizes)
    if int((a_sizes * b_sizes).sum()) > BLOCK:
        # Different ids of each group, and how often each is there.
        n_a_ids = int(a.max()) + 1
        a_keys, a_times = np.unique(a_group * n_a_ids + a, return_counts=True)
        b_keys, b_times = np.unique(b_group * n_b_ids + b, return_counts=True)
        a_group, a = np.divmod(a_keys, n_a_ids)
        b_group, b = np.divmod(b_keys, n_b_ids)
        by_id = np.argsort(a, kind="stable")
        a_group, a, a_times = a_group[by_id], a[by_id], a_times[by_id]
        b_in_group = np.bincount(b_group, minlength=len(groups))
    else:
        a_times = None  # every token counts once
        b_in_group = b_sizes
    b_start = np.cumsum(b_in_group) - b_in_group
    partners = b_in_group[a_group]
    listed = np.cumsum(partners)
    begin = 0
    while begin < len(a):
        done = listed[begin - 1] if begin else 0
        end = len(a)
        if listed[-1] - done > BLOCK:
            # As many whole A ids as fit, one at least.
            end = int(np.searchsorted(listed, done + BLOCK, side="right"))
            end = int(np.searchsorted(a, a[min(end, len(a) - 1)], side="left"))
            if end <= begin:
                end = int(np.searchsorted(a, a[begin], side="right"))
        taken = slice(begin, end)
        reps = partners[taken]
        first = np.repeat(b_start[a_group[taken]] - (np.cumsum(reps) - reps), reps)
        partner = first + np.arange(len(first))
        codes = np.repeat(a[taken], reps) * n_b_ids + b[partner]
        if a_times is None:
            yield np.unique(codes, return_counts=True)
        else:
            times = np.repeat(a_times[taken], reps) * b_times[partner]
            found, inverse = np.unique(codes, return_inverse=True)
            total = np.zeros(len(found), dtype=np.int64)
            np.add.at(total, inverse, times)
            yield found, total
        begin = end


def _aligned(text: str | None, made):
    """(A ids, B ids, places of common ends in A, in B), or None without tokens."""
    if not text:
        return None
    whole = " " + text
    raw = whole.encode("utf-8")
    (a_tokenizer, a_pieces, _), (b_tokenizer, b_pieces, _) = made
    a, b = a_tokenizer.encode(whole), b_tokenizer.encode(text)
    if not len(a) or not len(b) or a_pieces.joined(a) != raw or b_pieces.joined(b) != raw:
        return None
    a_ends, b_ends = np.cumsum(a_pieces.sizes[a]), np.cumsum(b_pieces.sizes[b])
    in_a, in_b = _common_places(a_ends, b_ends)
    return a, b, in_a, in_b


def _groups_text(a, b, in_a, in_b, made) -> bytes:
    """``a1,a2|b1;a3|b2,b3``.

    Each token's place in the text is its own number and the number of tokens of
    the other list before it: for A those up to the group before, for B those up
    to the end of the group.
    """
    (_, a_pieces, a_names), (_, b_pieces, b_names) = made
    names = np.empty(len(a) + len(b), dtype=a_names.dtype)
    a_sizes, b_sizes = np.diff(in_a, prepend=-1), np.diff(in_b, prepend=-1)
    a_named, b_named = a.copy(), b.copy()
    a_named[in_a] += len(a_pieces.sizes)
    b_named[in_b] += len(b_pieces.sizes)
    names[np.arange(len(a)) + np.repeat(in_b + 1 - b_sizes, a_sizes)] = a_names[a_named]
    names[np.arange(len(b)) + np.repeat(in_a + 1, b_sizes)] = b_names[b_named]
    return names.tobytes().translate(None, b"\0")[:-1]


def _contents(folder: str, a_file: str, b_file: str) -> tuple[bytes, bytes]:
    return Path(folder, a_file).read_bytes(), Path(folder, b_file).read_bytes()


def align_documents(
    docs: DataFrame,
    folder: str = TOKENIZERS,
    a_file: str = BYTE_BPE,
    b_file: str = PIECE_BPE,
    with_groups: bool = False,
) -> DataFrame:
    """Per document ``row, part, doc_id, n_a, n_b, n_groups, n_links, groups_sha256,
    codes, times`` and, where asked for, ``groups`` as ``a1,a2|b1;a3|b2,b3``.

    ``codes`` are the different linked id pairs, see ``linked_pairs``. A document
    with very many of them has further rows, ``part`` 1 and up, with only those.
    Texts that are NULL, empty or not given back whole by both tokenizers have
    zeros and empty columns. The vocabularies are read by the driver and
    broadcast; their size is that of two files.
    """
    spark = docs.sparkSession
    files = spark.sparkContext.broadcast(_contents(folder, a_file, b_file))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"row bigint, part int, doc_id {id_type}, n_a bigint, n_b bigint, n_groups bigint, "
        "n_links bigint, groups_sha256 string, codes array<bigint>, times array<bigint>"
    )
    schema += ", groups string" if with_groups else ""

    def rows_of(text, made):
        found = _aligned(text, made)
        if found is None:
            yield 0, 0, 0, 0, 0, "", [], [], ""
            return
        a, b, in_a, in_b = found
        a_sizes, b_sizes = np.diff(in_a, prepend=-1), np.diff(in_b, prepend=-1)
        groups = _groups_text(a, b, in_a, in_b, made)
        digest = hashlib.sha256(groups).hexdigest()
        counts = len(a), len(b), len(in_a), int((a_sizes * b_sizes).sum())
        blocks = linked_pairs(a, b, a_sizes, b_sizes, len(made[1][1].sizes))
        for part, (codes, times) in enumerate(blocks):
            yield part, *counts, digest, codes, times, groups.decode() if part == 0 and with_groups else ""

    def align(batches):
        made = _tokenizers(*files.value)
        for batch in batches:
            columns: list[list] = [[] for _ in range(11)]
            listed = 0
            for row, doc_id, text in zip(*(batch.column(i) for i in range(3))):
                for found in rows_of(text.as_py(), made):
                    for column, value in zip(columns, (row, doc_id, *found)):
                        column.append(value)
                    listed += len(found[6])
                    if listed > BLOCK:
                        yield _record(columns, batch.schema, with_groups)
                        columns, listed = [[] for _ in range(11)], 0
            if columns[0]:
                yield _record(columns, batch.schema, with_groups)

    taken = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.col("text").cast("string")
    )
    return map_batches(taken, align, schema)


def _record(columns: list[list], schema: pa.Schema, with_groups: bool) -> pa.RecordBatch:
    row, doc_id, part, n_a, n_b, n_groups, n_links, digest, codes, times, groups = columns

    def lists(values):
        offsets = np.cumsum([0, *(len(value) for value in values)]).astype(np.int32)
        flat = np.concatenate(values) if offsets[-1] else np.zeros(0)
        return pa.ListArray.from_arrays(offsets, pa.array(flat.astype(np.int64)))

    arrays = {
        "row": pa.array([value.as_py() for value in row], pa.int64()),
        "part": pa.array(part, pa.int32()),
        "doc_id": pa.array([value.as_py() for value in doc_id], schema.field("doc_id").type),
    }
    for name, values in (("n_a", n_a), ("n_b", n_b), ("n_groups", n_groups), ("n_links", n_links)):
        arrays[name] = pa.array(values, pa.int64())
    arrays |= {"groups_sha256": pa.array(digest), "codes": lists(codes), "times": lists(times)}
    if with_groups:
        arrays["groups"] = pa.array(groups)
    return pa.RecordBatch.from_pydict(arrays)


def pair_counts(aligned: DataFrame, n_b_ids: int) -> DataFrame:
    """Per linked id pair ``code, n, best``: in how many documents it is linked, and
    whether no pair of its A id is in more."""
    counts = settle(
        aligned.select(F.explode("codes").alias("code")).groupBy("code").agg(F.count("*").alias("n")),
        "pair_counts",
    )
    a_id = F.floor(F.col("code") / F.lit(n_b_ids))
    # One row per A id: its size is that of the vocabulary.
    most = counts.groupBy(a_id.alias("a")).agg(F.max("n").alias("most"))
    joined = counts.join(F.broadcast(most), a_id == F.col("a"))
    return joined.select("code", "n", (F.col("n") == F.col("most")).alias("best"))


def _frequent_from(pairs: DataFrame) -> int:
    """Least count with which a pair is one of the ``FREQUENT`` that are broadcast.

    Only the number of pairs per power of two reaches the driver.
    """
    power = F.floor(F.log2(F.col("n").cast("double"))).alias("power")
    counts = dict(pairs.groupBy(power).count().collect())
    total = 0
    for power in sorted(counts, reverse=True):
        total += counts[power]
        if total > FREQUENT:
            return 2 ** (power + 1)
    return 1


def score_links(aligned: DataFrame, n_b_ids: int) -> DataFrame:
    """Per ``row`` with links: ``n_best`` and ``count_sum`` over its links."""
    pairs = settle(pair_counts(aligned, n_b_ids), "pairs")
    zipped = F.explode(F.arrays_zip("codes", "times")).alias("link")
    links = aligned.select("row", zipped).select("row", "link.codes", "link.times")
    links = links.withColumnRenamed("codes", "code")

    def summed(joined: DataFrame) -> DataFrame:
        return joined.groupBy("row").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("n")).alias("count_sum"),
        )

    least = _frequent_from(pairs)
    frequent = F.broadcast(pairs.where(F.col("n") >= least))
    scores = summed(links.join(frequent, "code"))
    if least > 1:
        rest = links.join(frequent.select("code"), "code", "left_anti")
        rare = summed(rest.join(pairs.where(F.col("n") < least), "code"))
        scores = scores.union(rare).groupBy("row").agg(
            F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")
        )
    return scores


def align_and_score(
    docs: DataFrame, folder: str = TOKENIZERS, a_file: str = BYTE_BPE, b_file: str = PIECE_BPE
) -> DataFrame:
    """Per document ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256``.

    ``n_best`` is the number of links whose pair is in as many documents as any
    pair of its A id, ties included; ``count_sum`` adds the documents of the pair
    over all links. Texts that are NULL, empty or not given back whole have zeros
    and an empty digest; repeated rows and rows of one id are documents of their
    own; texts of any length are taken whole; an empty table gives no rows; other
    columns, whatever their names, are not read.
    """

    def scored() -> DataFrame:
        aligned = settle(align_documents(docs, folder, a_file, b_file), "aligned")
        n_b_ids = len(_tokenizers(*_contents(folder, a_file, b_file))[1][1].sizes)
        scores = score_links(aligned, n_b_ids)
        joined = aligned.where(F.col("part") == 0).join(scores, "row", "left")
        return joined.select(
            "doc_id",
            "n_a",
            "n_b",
            "n_groups",
            "n_links",
            F.coalesce("n_best", F.lit(0)).cast("bigint").alias("n_best"),
            F.coalesce("count_sum", F.lit(0)).cast("bigint").alias("count_sum"),
            "groups_sha256",
        )

    return settle_result(docs.sparkSession, scored, "alignment")
