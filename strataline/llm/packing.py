"""Packing: documents become token pieces, and Karmarkar-Karp differencing deals the pieces to windows.

A document's ids, closed by ``END_ID``, are cut into whole windows and a rest; a rest above ``cut`` ids is cut
once more, because differencing balances small pieces better. Whole windows need no partner. The others are dealt
by a hash into groups of about ``group_pieces``; in each group multiway differencing repeatedly merges the two
partial partitions with the largest imbalance, heaviest windows with lightest, which gives near-equal windows.
It starts from the least window count that could hold the group and raises it while a window is over capacity.

Ids never leave the task that makes them: a piece carries their number and checksum. Pieces are written to the
shared folder before they are grouped.

Defined cases: null text is empty and becomes the single id ``END_ID``; repeated rows are packed as often as they
occur; a null document id is an id; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
import operator
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from strataline.llm.common import text_or_empty
from strataline.session import stage

CAPACITY = 1024
END_ID = 0
# Rests are cut to pieces of at most so many ids.
CUT = 340
GROUP_PIECES = 512
# Sequences of one whole window are numbered from here on, above those of all groups.
WHOLE = 1 << 62
# Bytes of texts whose words are encoded together.
SLICE_BYTES = 16_000_000
# Texts that are more than words between single spaces and newlines: empty, with white space at an end, twice in a row or of another kind.
OTHER_SPACE = (
    r"\A\z|\A[ \n]|[ \n]\z|[ \n][ \n]|[\t\x0B-\r\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)

_SUM = operator.itemgetter(0)


def batch_encoder(ranks_path: str, tokenizer_path: str, pattern: str) -> Callable[[pa.Array], list[np.ndarray]]:
    """Texts to their ids, as little-endian unsigned 32-bit integers.

    The vocabulary splits text before a space and around a newline, so in texts whose white space is single spaces and
    newlines the ids of a line are those of its words. The distinct words of all such texts go to the library in one
    call, each after a newline, whose id no word contains, and the ids of the texts are put together from theirs. Any
    other text goes to the library whole, and text with a special token's name goes to the tokenizer file itself.
    """
    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    plain = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    full = Tokenizer.from_file(tokenizer_path)
    special = [t.content for t in full.get_added_tokens_decoder().values()]

    def library(text: str) -> np.ndarray:
        if any(name in text for name in special):
            return np.array(full.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return np.array(plain.encode_ordinary(text), dtype="<u4")

    (newline,) = library("\n")
    line, after, nothing = (pa.scalar(s, pa.large_string()) for s in ("\n", "\n ", ""))

    def by_words(texts: pa.Array) -> Iterator[np.ndarray]:
        # A word at the start of a line keeps the newline before it, every other word is one after a space.
        lines = pc.binary_join_element_wise(line, pc.replace_substring(texts, "\n", " \n"), nothing)
        split = pc.split_pattern(lines, " ")
        words = split.flatten().dictionary_encode()
        first = pc.starts_with(words.dictionary, "\n")
        forms = pc.if_else(first, words.dictionary, pc.binary_join_element_wise(after, words.dictionary, nothing))
        ids = library(pc.binary_join(pa.LargeListArray.from_arrays([0, len(forms)], forms), nothing)[0].as_py())
        begin = np.flatnonzero(ids == newline)
        end = np.append(begin[1:], len(ids))
        begin = np.where(first.to_numpy(zero_copy_only=False), begin, begin + 1)
        at = words.indices.to_numpy()
        sizes = (end - begin)[at]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        made = ids[np.repeat(begin[at] - ends[:-1], sizes) + np.arange(ends[-1])]
        bounds = ends[split.offsets.to_numpy() - split.offsets[0].as_py()]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            # Without the newline put before the text.
            yield made[a + 1 : b]

    def run(texts: pa.Array) -> list[np.ndarray]:
        texts = texts.cast(pa.large_string())
        whole = pc.match_substring_regex(texts, OTHER_SPACE)
        for name in special:
            whole = pc.or_(whole, pc.match_substring(texts, name))
        spaced = texts.filter(pc.invert(whole))
        found = by_words(spaced) if len(spaced) else iter(())
        return [library(t.as_py()) if w else next(found) for t, w in zip(texts, whole.to_pylist(), strict=True)]

    return run


def encoder(ranks_path: str, tokenizer_path: str, pattern: str) -> Callable[[str], bytes]:
    """One text to its ids."""
    encode = batch_encoder(ranks_path, tokenizer_path, pattern)
    return lambda text: encode(pa.array([text]))[0].tobytes()


def cuts(n: int, capacity: int = CAPACITY, cut: int = CUT) -> Iterator[tuple[int, int]]:
    """Start and length of a document's pieces: whole windows, then the rest in equal parts of at most ``cut``."""
    whole = n // capacity * capacity
    for start in range(0, whole, capacity):
        yield start, capacity
    rest = n - whole
    parts = -(-rest // cut)
    for k in range(parts):
        a, b = rest * k // parts, rest * (k + 1) // parts
        yield whole + a, b - a


def difference(sizes: Sequence[int], ways: int) -> list[list[int]]:
    """Multiway Karmarkar-Karp: the indices of ``sizes`` in at most ``ways`` sets of near-equal sums.

    A partial partition is a sorted list of its non-empty sets, as (sum, number, members); its imbalance is the
    largest sum less the smallest, which is zero while a set is empty. The two partitions of largest imbalance
    are merged, the heaviest set of one with the lightest of the other, until one is left.
    """
    heap = [(-size, i, [(size, i, (i, None))]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    number = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        if len(a) < len(b):
            a, b = b, a
        empty = min(ways - len(a), len(b))
        merged = b[len(b) - empty :]
        for (x, _, in_x), (y, _, in_y) in zip(a, b[len(b) - empty - 1 :: -1] if empty < len(b) else (), strict=False):
            merged.append((x + y, number, (in_x, in_y)))
            number += 1
        merged += a[len(b) - empty :]
        merged.sort(key=_SUM)
        spread = merged[-1][0] - (merged[0][0] if len(merged) == ways else 0)
        number += 1
        heapq.heappush(heap, (-spread, number, merged))
    return [_members(s[2]) for s in heap[0][2]] if heap else []


def _members(tree: tuple) -> list[int]:
    """The indices under a set: a leaf is (index, None), a merge is a pair of sets."""
    out, todo = [], [tree]
    while todo:
        left, right = todo.pop()
        if right is None:
            out.append(left)
        else:
            todo += (left, right)
    return out


def windows(sizes: Sequence[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Near-equal windows within capacity; their number rises whenever a window would exceed it."""
    ways = max(1, -(-sum(sizes) // capacity))
    while True:
        dealt = difference(sizes, ways)
        if all(sum(sizes[i] for i in w) <= capacity for w in dealt):
            return dealt
        ways += 1


def pieces(
    docs: DataFrame, files: dict[str, str], id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, cut: int = CUT
) -> DataFrame:
    """Pieces of every document, with ``row``: the number of the document within its task, which tells repeats apart."""

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, row long, start long, length long, ids_crc32 long, doc_tokens long"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = batch_encoder(**files)
        row = 0
        for batch in batches:
            for part in _slices(batch):
                out = []
                for doc_id, ids in zip(part.column(0).to_pylist(), encode(part.column(1)), strict=True):
                    ids = np.append(ids, np.uint32(END_ID))
                    for start, length in cuts(len(ids), capacity, cut):
                        out.append((doc_id, row, start, length, zlib.crc32(ids[start : start + length]), len(ids)))
                    row += 1
                columns = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return docs.select(id_col, text_or_empty(text_col)).mapInArrow(run, schema)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch cut where its texts pass multiples of ``SLICE_BYTES``."""
    sizes = pc.binary_length(batch.column(1)).to_numpy()
    number = (np.cumsum(sizes, dtype=np.int64) - sizes) // SLICE_BYTES
    cut_at = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cut_at[:-1], cut_at[1:], strict=True):
        if b > a:
            yield batch.slice(a, b - a)


def pack(
    docs: DataFrame,
    files: dict[str, str],
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    cut: int = CUT,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """One row per piece: its document, start, length, ids_crc32, doc_tokens, sequence_id and offset.

    A whole window is a sequence by itself, numbered by the place of its piece in the written table from
    ``WHOLE`` on; only the shorter pieces are grouped.
    """
    numbered = pieces(docs, files, id_col, text_col, capacity, cut).withColumn("piece", F.monotonically_increasing_id())
    made = stage(numbered, "pieces")
    short = made.filter(F.col("length") < capacity)
    groups = max(1, -(-short.count() // group_pieces))
    schema = made.drop("row", "piece").schema.add("sequence_id", "long").add("offset", "long")
    group = F.pmod(F.xxhash64(F.col(id_col), "row", "start", "ids_crc32"), F.lit(groups)).cast("long")

    def deal(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values([id_col, "row", "start"], ignore_index=True)
        sizes = part["length"].tolist()
        sequence, offset = np.zeros(len(part), dtype=np.int64), np.zeros(len(part), dtype=np.int64)
        for k, members in enumerate(windows(sizes, capacity)):
            at = 0
            for i in members:
                sequence[i], offset[i] = k, at
                at += sizes[i]
        return part.assign(sequence_id=key[0] << 32 | sequence, offset=offset).drop(columns=["row", "piece", "group"])

    dealt = short.withColumn("group", group).groupBy("group").applyInPandas(deal, schema)
    whole = made.filter(F.col("length") >= capacity).select(
        *schema.names[:-2], (F.lit(WHOLE) + F.col("piece")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return dealt.unionByName(whole)
