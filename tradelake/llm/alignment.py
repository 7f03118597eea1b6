"""Two tokenizers' cuts of the same texts, aligned group by group and counted over the corpus.

Tokens of both are byte ranges of the same bytes.  Every token points to the farthest-right token it
overlaps; following pointers ends at the last token of its group, which ends where a token of the
other tokenizer ends too.  All pointers of a step are followed at once, twice as far each time
(``pointer = pointer[pointer]``), until none moves; the token reached names the group.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.llm.common import packed, pieces, quoted, stored

#: Pairs whose counts are sent to every task; the counts of all others are joined by a shuffle.
HEAD = 1 << 20
#: Pairs that a task counts before it hands them on.
HELD = 1 << 20
#: Bytes of text that one step of a task cuts into tokens.
STEP = 1 << 20
#: Bits of a pair that hold the id of the second tokenizer.
B_BITS = 15
#: Characters whose classes are as old as the split pattern; texts of others go to the file's own library.
PLAIN = regex.compile(r"[\x00-ɏ]*")
#: Longest text given to the quick encoder, which recurses on runs of blanks.
QUICK = 1 << 18
#: Where no token of either side crosses: before a blank or line end that follows anything but a blank.
CUT = re.compile(r"(?<=\S)(?=[ \n])")
#: Different words that a task's process keeps aligned.
WORDS = 1 << 18


def _letters() -> dict[str, int]:
    """The characters that byte-level vocabularies write bytes as."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteTokens:
    """A byte-level BPE file; ``tokens`` are the bytes of each id.

    Where the ids are the order of the merges and the split is the usual one, the same merges run in
    a quicker library, for texts of characters that both libraries class alike.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            held = json.load(f)
        letters = _letters()
        special = {t["id"] for t in held.get("added_tokens", [])}
        vocab = held["model"]["vocab"]
        self.tokens = [b""] * (max([*vocab.values(), *special]) + 1)
        for text, i in vocab.items():
            self.tokens[i] = text.encode() if i in special else bytes(letters[c] for c in text)
        self.quick = self._quick(held, special)

    def _quick(self, held: dict, special: set[int]):
        model, split = held["model"], held.get("pre_tokenizer") or {}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        in_order = all(model["vocab"].get(a + b) == 256 + k for k, (a, b) in enumerate(merges))
        usual = split.get("type") == "ByteLevel" and split.get("use_regex", True) and held.get("normalizer") is None
        if not in_order or not usual or len(merges) + 256 + len(special) != len(self.tokens):
            return None
        import tiktoken

        # the pattern of byte-level splits
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        ranks = {b: i for i, b in enumerate(self.tokens) if i not in special}
        return tiktoken.Encoding("merges", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if self.quick and len(text) <= QUICK and PLAIN.fullmatch(text):
            return self.quick.encode_ordinary(text)
        return self.slow.encode(text, add_special_tokens=False).ids


class PieceTokens:
    """A sentence-piece file; it adds the leading space itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.tokens = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                self.tokens.append(bytes([int(piece[3:-1], 16)]))
            else:
                self.tokens.append(piece.replace("▁", " ").encode())
        self.by_words = self._by_words()

    def _by_words(self) -> bool:
        """Whether texts can be encoded word by word: they stay as they are, and no piece goes on past a word's end."""
        try:
            from sentencepiece import sentencepiece_model_pb2
        except ImportError:
            return False
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(self.model.serialized_model_proto())
        rules, trainer = proto.normalizer_spec, proto.trainer_spec
        same = not rules.precompiled_charsmap and not rules.remove_extra_whitespaces
        same = same and rules.escape_whitespaces and rules.add_dummy_prefix and not trainer.treat_whitespace_as_suffix
        bpe = trainer.model_type == trainer.BPE and not any(p.type == p.USER_DEFINED for p in proto.pieces)
        inside = any("▁" in p.piece.lstrip("▁") or " " in p.piece or "\n" in p.piece for p in proto.pieces)
        return same and bpe and not inside

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """The ids of words as they are in a text; those that no blank begins lose the one added."""
        found = self.model.encode([w[1:] if w[:1] == " " else w for w in words], num_threads=1)
        return [ids if w[:1] == " " else ids[1:] for w, ids in zip(words, found, strict=True)]

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


@cache
def _tokenizers(a_path: str, b_path: str):
    """Both tokenizers, their tokens' lengths, the ids as text followed by each separator, and aligned words."""
    a, b = ByteTokens(a_path), PieceTokens(b_path)
    if len(b.tokens) > 1 << B_BITS or len(a.tokens) > 1 << (31 - B_BITS):
        raise ValueError("vocabularies too large for a pair of 31 bits")
    lengths = [np.array([len(t) for t in x.tokens], np.int64) for x in (a, b)]
    shown = np.array([f"{i}{s}" for i in range(max(len(a.tokens), len(b.tokens))) for s in (",", "|", ";")], object)
    return a, b, *lengths, shown, Words(a, b, lengths, shown)


def terminals(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the tokens of each side the number of the B token that ends their group.

    Both sides cover the same bytes.  A token's farthest-right overlapping token holds its last
    byte; where both end there, the group ends.
    """
    n = len(a_ends)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # nodes: A tokens, then B tokens
    over_a = n + np.searchsorted(b_ends, a_ends, "left")
    over_b = np.searchsorted(a_ends, b_ends, "left")
    alone = a_ends[over_b] == b_ends
    over_b = np.where(alone, n + np.arange(len(b_ends)), over_b)
    pointer = np.concatenate((over_a, over_b))
    while True:
        further = pointer[pointer]
        if (further == pointer).all():
            return pointer[:n] - n, pointer[n:] - n
        pointer = further


def links(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of an A and a B token whose byte ranges overlap: one for each stretch between ends."""
    ends = np.union1d(a_ends, b_ends)
    return np.searchsorted(a_ends, ends, "left"), np.searchsorted(b_ends, ends, "left")


def groups_list(a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray, shown: np.ndarray) -> list[str]:
    """``a1,a2|b1;a3|b2,b3;``: the ids of each group, A before B, each with what separates it from the next."""
    if not len(a):
        return []
    out = np.empty(len(a) + len(b), np.int64)
    a_last = np.concatenate((a_group[1:] != a_group[:-1], [True]))
    b_last = np.concatenate((b_group[1:] != b_group[:-1], [True]))
    before = np.searchsorted(b_group, a_group, "left")  # B tokens of earlier groups
    upto = np.searchsorted(a_group, b_group, "right")  # A tokens of this group and earlier ones
    out[np.arange(len(a)) + before] = a * 3 + a_last
    out[np.arange(len(b)) + upto] = b * 3 + 2 * b_last
    return shown[out].tolist()


class Words:
    """Aligned words: texts are cut where no token crosses, so groups and links lie inside words.

    ``held``: of each word the numbers of tokens, groups and links, the groups' text and the linked pairs
    as bytes; None where a tokenizer changes its bytes.
    """

    def __init__(self, a: ByteTokens, b: PieceTokens, lengths: list[np.ndarray], shown: np.ndarray) -> None:
        self.a, self.b, self.lengths, self.shown = a, b, lengths, shown
        self.held: dict[str, tuple | None] = {}
        self.usable = a.quick is not None and b.by_words

    def cut(self, text: str | None) -> list[str]:
        """The words of a space and the text; none for texts that have to be encoded whole."""
        if not text or not self.usable or len(text) > QUICK or not PLAIN.fullmatch(text):
            return []
        return CUT.split(" " + text)

    def learn(self, texts: list[list[str]]) -> None:
        """Aligns the words that aren't held, all at once."""
        if len(self.held) > WORDS:
            self.held.clear()
        new = [w for w in dict.fromkeys(w for words in texts for w in words) if w not in self.held]
        if not new:
            return
        sides = [[self.a.quick.encode_ordinary(w) for w in new], self.b.encode_words(new)]
        same = [
            b"".join([self.a.tokens[i] for i in x]) == b"".join([self.b.tokens[i] for i in y]) == w.encode()
            for w, x, y in zip(new, *sides, strict=True)
        ]
        self.held.update((w, None) for w, ok in zip(new, same, strict=True) if not ok)
        new, *sides = ([x for x, ok in zip(side, same, strict=True) if ok] for side in (new, *sides))
        if not new:
            return
        a, b = (np.fromiter(chain.from_iterable(side), np.int64) for side in sides)
        n_a, n_b = (np.array([len(ids) for ids in side], np.int64) for side in sides)
        a_ends, b_ends = (np.cumsum(n[ids]) for n, ids in zip(self.lengths, (a, b), strict=True))
        a_group, b_group = terminals(a_ends, b_ends)
        x, y = links(a_ends, b_ends)
        pairs = ((a[x] << B_BITS) | b[y]).astype(np.int32).tobytes()
        a_stops, b_stops = np.cumsum(n_a), np.cumsum(n_b)
        link_stops = np.searchsorted(x, a_stops, "left")
        ends = np.append(a_group[1:] != a_group[:-1], True)
        groups = np.cumsum(ends)[a_stops - 1]
        shown = groups_list(a, b, a_group, b_group, self.shown)
        p0 = q0 = g0 = m0 = 0
        for w, p, q, g, m in zip(new, *(k.tolist() for k in (a_stops, b_stops, groups, link_stops)), strict=True):
            text = "".join(shown[p0 + q0 : p + q])[:-1]
            self.held[w] = (p - p0, q - q0, g - g0, m - m0, text, pairs[4 * m0 : 4 * m])
            p0, q0, g0, m0 = p, q, g, m


COLUMNS = "n_a long, n_b long, n_groups long, n_links long, groups string, links array<int>"


def _aligned(batches: Iterable[pa.RecordBatch], a_path: str, b_path: str) -> Iterator[pa.RecordBatch]:
    a_path, b_path = (p if os.path.exists(p) else SparkFiles.get(os.path.basename(p)) for p in (a_path, b_path))
    first, second, a_lengths, b_lengths, shown, words = _tokenizers(a_path, b_path)
    for batch in pieces(batches, "text", STEP):
        rows: list[list] = [[], [], [], [], []]
        held = []
        texts = batch.column("text").to_pylist()
        cuts = [words.cut(text) for text in texts]
        words.learn(cuts)
        for text, cut in zip(texts, cuts, strict=True):
            known = list(map(words.held.get, cut))
            if known and None not in known:
                *counts, groups, pairs = zip(*known, strict=True)
                held.append(np.frombuffer(b"".join(pairs), np.int32))
                for out, value in zip(rows, (*map(sum, counts), ";".join(groups)), strict=True):
                    out.append(value)
                continue
            a, b = _both(first, second, text)
            a_ends, b_ends = np.cumsum(a_lengths[a]), np.cumsum(b_lengths[b])
            a_group, b_group = terminals(a_ends, b_ends)
            x, y = links(a_ends, b_ends)
            held.append(((a[x] << B_BITS) | b[y]).astype(np.int32))
            n_groups = int((a_group[1:] != a_group[:-1]).sum()) + 1 if len(a) else 0
            for out, value in zip(rows, (len(a), len(b), n_groups, len(x), "".join(groups_list(a, b, a_group, b_group, shown))[:-1]), strict=True):
                out.append(value)
        ends = np.concatenate(([0], np.cumsum([len(x) for x in held])))
        pairs = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(held)))
        counts = [pa.array(x, pa.int64()) for x in rows[:4]]
        yield pa.RecordBatch.from_arrays(
            [batch.column("_row"), *counts, pa.array(rows[4], pa.string()), pairs],
            names=["_row", "n_a", "n_b", "n_groups", "n_links", "groups", "links"],
        )


def _both(first: ByteTokens, second: PieceTokens, text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Ids of both tokenizers; none where either's bytes aren't a space and the text."""
    if text:
        whole = b" " + text.encode()
        a, b = first.encode(" " + text), second.encode(text)
        if all(b"".join([side.tokens[i] for i in ids]) == whole for side, ids in ((first, a), (second, b))):
            return np.array(a, np.int64), np.array(b, np.int64)
    return np.zeros(0, np.int64), np.zeros(0, np.int64)


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of all lists and how many each has."""
    return column.flatten().to_numpy(), column.value_lengths().fill_null(0).to_numpy().astype(np.int64)


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many rows hold each pair, as sums over parts of a task of at most HELD pairs and a batch."""
    keys, sums = np.zeros(0, np.int32), np.zeros(0, np.int64)
    for batch in batches:
        values, sizes = _flat(batch.column("links"))
        # rows are cut so that a step holds about HELD links, one row at least
        step = np.cumsum(sizes) // HELD
        for at in np.unique(step):
            rows = np.flatnonzero(step == at)
            lo, hi = (int(x) for x in (sizes[: rows[0]].sum(), sizes[: rows[-1] + 1].sum()))
            text = np.repeat(rows, sizes[rows])
            each = np.unique((text.astype(np.int64) << 31) | values[lo:hi]) & ((1 << 31) - 1)
            key, n = np.unique(each.astype(np.int32), return_counts=True)
            keys, where = np.unique(np.concatenate((keys, key)), return_inverse=True)
            sums = np.bincount(where, np.concatenate((sums, n)), len(keys)).astype(np.int64)
            if len(keys) > HELD:
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums)], names=["pair", "n"])
                keys, sums = keys[:0], sums[:0]
    if len(keys):
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums)], names=["pair", "n"])


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, n, best``: rows that hold each pair linked; ``best``: no pair of its A id has more."""
    counted = stored(aligned.select("links").mapInArrow(_counted, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")), "token-pairs")
    a = F.shiftright("pair", B_BITS).alias("a")
    # a row for each id of a vocabulary of at most 2^16
    highest = stored(counted.groupBy(a).agg(F.max("n").alias("most")), "token-best")
    joined = counted.withColumn("a", a).join(F.broadcast(highest), "a")
    return joined.select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _head(counts: DataFrame, most: int) -> tuple[np.ndarray, ...]:
    """The commonest pairs, sorted, with counts and marks: all above a count that at most ``most`` exceed."""
    # how many pairs have a count of each power of two: 64 rows
    sizes = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("p")).agg(F.count(F.lit(1)).alias("k")).collect()
    least, held = 64, 0
    for row in sorted(sizes, key=lambda r: -r.p):
        held += row.k
        if held > most:
            break
        least = row.p
    table = counts.where(F.floor(F.log2("n")) >= least).toArrow().sort_by("pair")
    return tuple(table.column(c).to_numpy() for c in ("pair", "n", "best"))


def _summed(batches: Iterable[pa.RecordBatch], head) -> Iterator[pa.RecordBatch]:
    """``n_best`` and ``count_sum`` of the links whose counts are at hand; the others stay in ``rest``."""
    keys, counts, best = head.value
    for batch in batches:
        values, sizes = _flat(batch.column("links"))
        n_best, total, rest, ends = [], [], [], [0]
        stops = np.cumsum(sizes)
        for lo, hi in zip((stops - sizes).tolist(), stops.tolist(), strict=True):
            part = values[lo:hi]
            if len(keys):
                at = np.minimum(np.searchsorted(keys, part), len(keys) - 1)
                known = keys[at] == part
            else:
                at, known = np.zeros(len(part), int), np.zeros(len(part), bool)
            n_best.append(int(best[at[known]].sum()) if known.any() else 0)
            total.append(int(counts[at[known]].sum()) if known.any() else 0)
            rest.append(part[~known])
            ends.append(ends[-1] + len(rest[-1]))
        left = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(rest) if rest else values))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in PASSED), pa.array(n_best, pa.int64()), pa.array(total, pa.int64()), left],
            names=[*PASSED, "n_best", "count_sum", "rest"],
        )


PASSED = ["no", "_row", "n_a", "n_b", "n_groups", "n_links", "groups"]


def align(docs: DataFrame, a_path: str, b_path: str, *, text_col: str = "text", digest: bool = False, head: int = HEAD) -> DataFrame:
    """The rows of ``docs``, without the text, with ``n_a, n_b, n_groups, n_links, groups, n_best, count_sum``.

    A is a byte-level BPE file, given a space and the text; B a sentence-piece file, given the text, to
    which it adds the space.  ``groups`` lists the ids between places where tokens of both end, as
    ``a1,a2|b1;a3|b2,b3``; with ``digest`` it is the SHA-256 of that text instead, so that no text as
    long as the documents is written.  Linked are an A and a B token that share a byte; a pair of ids
    counts the rows that hold it linked.  ``n_best`` links have a count that no other pair of their A
    id exceeds; ``count_sum`` sums the counts over links.

    Paths must be readable on every executor, or given to it by ``addFile``.  Counts of the commonest
    ``head`` pairs at most are sent to the tasks; links of rarer pairs go to their counts by a shuffle.

    Null and empty texts, and texts whose bytes either tokenizer changes, have no tokens: all numbers are
    zero and ``groups`` is empty.  Special tokens' names in a text are text.  Repeated rows each
    count.  Input columns with the names of new ones give way.  An empty table gives no rows.
    """
    spark: SparkSession = docs.sparkSession
    own = ["n_a", "n_b", "n_groups", "n_links", "groups", "links", "n_best", "count_sum", text_col]
    kept = packed(docs, own) if set(docs.columns) - set(own) else F.struct(F.lit(None).cast("int").alias("none")).alias("_row")
    rows = docs.select(kept, quoted(text_col).cast("string").alias("text"))
    kind = rows.schema["_row"].dataType.simpleString()
    found = rows.mapInArrow(lambda x: _aligned(x, a_path, b_path), f"_row {kind}, {COLUMNS}")
    if digest:
        found = found.withColumn("groups", F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)))
    aligned = stored(found.withColumn("no", F.monotonically_increasing_id()), "aligned")
    counts = stored(pair_counts(aligned), "token-counts")
    table = spark.sparkContext.broadcast(_head(counts, head))
    schema = ", ".join(f"{c} {aligned.schema[c].dataType.simpleString()}" for c in PASSED)
    sums = aligned.select(*PASSED, "links").mapInArrow(lambda x: _summed(x, table), f"{schema}, n_best long, count_sum long, rest array<int>")
    sums = stored(sums, "link-sums")
    rare = sums.select("no", F.explode("rest").alias("pair")).join(counts, "pair")
    rare = rare.groupBy("no").agg(F.count_if("best").alias("more_best"), F.sum("n").alias("more"))
    # only rows with rare links are joined
    none = F.lit(0).cast("long")
    whole = sums.where(F.size("rest") == 0).drop("rest").withColumns({"more_best": none, "more": none})
    out = whole.unionByName(sums.where(F.size("rest") > 0).drop("rest").join(rare, "no"))
    row = [c for c in docs.columns if c.lower() not in own]
    return out.select(
        *(F.col("_row")[c].alias(c) for c in row),
        "n_a", "n_b", "n_groups", "n_links", "groups",
        (F.col("n_best") + F.col("more_best")).alias("n_best"),
        (F.col("count_sum") + F.col("more")).alias("count_sum"),
    )
