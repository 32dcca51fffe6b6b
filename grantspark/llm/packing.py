"""Best-fit packing of token sequences by a configuration linear program (operator 3).

Texts become ids, documents over the capacity are cut into full pieces (the first piece takes the rest), and the piece
lengths are counted: at most ``capacity`` numbers, whatever the corpus. On that histogram the driver solves the
configuration program (how often to fill a sequence in each way so that every length is covered). Multiplicative
weights price the lengths: a length's weight falls as it is covered. A knapsack dynamic program finds the best-valued
fillings, several per round from one table. Whole parts are fixed, the rest is solved again, and what is left at the
end, a number bounded by the parameters, goes best fit in decreasing order.

Pieces meet the plan without a shuffle of their ids and without a window over a length: each task numbers the pieces of
a length it sees, the counts by (task, length) give each task's first number, and a piece's number picks its sequence
and place from the plan, a table bounded by the parameters.

Null texts count as empty (only the closing id). Repeated rows, null ids and further columns do no harm; an empty table
gives no rows.
"""

from __future__ import annotations

import os
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, query, release_worker_state, runs_of, table, vocabulary_path, worker_state

CAPACITY = 2048
END_ID = 0
#: Parts of texts a worker remembers the ids of, in each of two generations, and characters of the longest of them.
KEPT_WORDS, KEPT_CHARS = 300_000, 64
#: Bytes of text worked on at once.
RUN_BYTES = 8 << 20
#: The solver's bounds: pricing rounds of a pass, fillings per round.
ROUNDS, FILLINGS = 24, 96
#: Passes: whole parts of fillings with at most so many empty places are fixed, then the rest is solved again.
SLACKS = (0, 0, 0, 2, 8, 32)
#: After a pass that leaves at most so many pieces, best fit of the rest is tried; the best pass counts.
LAST_STEP = 200_000
#: Where the bound by total length is missed, such shares of the fixed fillings are given back to the last step.
RELEASED = (0.2, 0.4, 0.6, 0.8)
#: Weight of a length when it is covered once: exp(-RATE).
RATE = 3.0

# What a byte of a text is; a few signs beyond ASCII are not known to be anything, so that no cut is made beside them.
WHITE, SPACE, LETTER, DIGIT, MARK, OPENS, LETTER_OPENS, GOES_ON = (1 << i for i in range(8))


def _kinds() -> np.ndarray:
    kinds = np.zeros(256, np.uint8)
    kinds[list(b"\t\n\x0b\x0c\r ")] = WHITE
    kinds[0x20] |= SPACE
    kinds[0x21:0x7F] = MARK
    for kind, first, last in ((LETTER, "A", "Z"), (LETTER, "a", "z"), (DIGIT, "0", "9")):
        kinds[ord(first):ord(last) + 1] = kind
    # no white space begins with these; of two bytes that begin with some all are letters, but for the signs that end in 97 and b7
    kinds[[0xC3, *range(0xC4, 0xE1), *range(0xE4, 0xF5)]] = OPENS
    kinds[[*range(0xC3, 0xC9), 0xD0, 0xD1]] |= LETTER_OPENS
    kinds[0x80:0xC0] = GOES_ON
    kinds[[0x97, 0xB7]] = 0
    return kinds


KINDS = _kinds()


def match_starts(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Places in texts laid end to end where a match of the tokenizer's splitting pattern begins, whatever comes before.

    Most words and marks begin at one. What lies between two such places is split alone as it is inside its text: a space before
    anything but white space belongs to what follows, white space otherwise begins after a word or mark, and letters, digits and
    marks begin after each other (an apostrophe before letters may be a contraction, so these do not).
    """
    kinds = KINDS[raw]
    cut = np.zeros(len(raw), bool)
    solid = (kinds & (LETTER | DIGIT | MARK | OPENS)) != 0
    before_solid = np.zeros(len(raw), bool)
    before_solid[:-1] = solid[1:]
    before_solid[starts[starts > 0] - 1] = False  # another text's
    white = (kinds & WHITE) != 0
    letter = (kinds & LETTER) != 0
    ends_letter = letter.copy()
    ends_letter[1:] |= ((kinds[1:] & GOES_ON) != 0) & ((kinds[:-1] & LETTER_OPENS) != 0)
    digit, mark = (kinds & DIGIT) != 0, (kinds & MARK) != 0
    ends_word = ends_letter | digit
    ends_solid = ends_word | mark
    space = (kinds & SPACE) != 0
    cut[:] = space & before_solid
    cut[1:] |= white[1:] & ends_solid[:-1]
    cut[1:] |= mark[1:] & ends_word[:-1]
    cut[1:] |= digit[1:] & (letter | mark)[:-1]
    cut[1:] |= letter[1:] & (digit | (mark & (raw != 0x27)))[:-1]
    cut[2:] |= solid[2:] & (white & ~space)[1:-1] & ends_solid[:-2]
    cut[starts[starts < len(raw)]] = True
    return np.flatnonzero(cut)


class ChunkIds:
    """Ids of texts by the tokenizers library; words and runs of marks are remembered in two generations."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        # tokens that begin with a space or a line end, which the byte-level vocabulary spells so
        self.opens = {mark: np.zeros(self.tokenizer.get_vocab_size(), bool) for mark in " \n"}
        for mark, spelt in ((" ", "\u0120"), ("\n", "\u010a")):
            self.opens[mark][[i for token, i in self.tokenizer.get_vocab().items() if token.startswith(spelt)]] = True

    def encode(self, parts: list[str]) -> list[bytes]:
        found: list[bytes] = []
        for i in range(0, len(parts), 2000):
            found += [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(parts[i:i + 2000], add_special_tokens=False)]
        return found

    def encode_words(self, words: list[str], mark: str) -> list[bytes]:
        """Ids of words of letters, many at a time: with a space before each, or without one and cut out between line ends."""
        found: list[bytes] = []
        bare = mark == "\n"
        for i in range(0, len(words), 20_000):
            runs = [words[j:j + 200] for j in range(i, min(i + 20_000, len(words)), 200)]
            for run, e in zip(runs, self.tokenizer.encode_batch_fast([mark + mark.join(run) for run in runs], add_special_tokens=False)):
                ids = np.array(e.ids, "<u4")
                starts = np.flatnonzero(self.opens[mark][ids])
                if len(starts) != len(run):
                    found += self.encode(run if bare else [" " + w for w in run])
                    continue
                raw, cuts = ids.tobytes(), [*(starts * 4).tolist(), 4 * len(ids)]
                found += [raw[a + 4 * bare:b] for a, b in zip(cuts, cuts[1:])]
        return found

    def learn(self, parts: list[str]) -> dict[str, bytes]:
        """The ids of parts that are not remembered yet; all but long ones are remembered from now on."""
        spaced, bare, hard = [], [], []
        for part in parts:
            if part.isalpha():
                bare.append(part)
            elif part[0] == " " and part[1:].isalpha():
                spaced.append(part)
            else:
                hard.append(part)
        found = dict(zip(spaced, self.encode_words([part[1:] for part in spaced], " ")))
        found.update(zip(bare, self.encode_words(bare, "\n")))
        found.update(zip(hard, self.encode(hard)))
        self.young.update((part, ids) for part, ids in found.items() if len(part) <= KEPT_CHARS)
        return found

    def column(self, texts: pa.Array, end: bytes) -> pa.Array:
        """The ids of each text (none null), closed by ``end``: parts are told apart, looked up and put together as Arrow columns."""
        texts = texts.cast(pa.string())
        _, ends, data = texts.buffers()
        places = np.frombuffer(ends, np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
        raw = np.frombuffer(data, np.uint8)[places[0]:places[-1]] if places[-1] > places[0] else np.zeros(0, np.uint8)
        places = places - places[0]
        cuts = match_starts(raw, places[:-1])
        parts = pa.StringArray.from_buffers(len(cuts), pa.py_buffer(np.append(cuts, len(raw)).astype(np.int32)), pa.py_buffer(raw)).dictionary_encode()
        kinds = parts.dictionary.to_pylist()
        if len(self.young) > KEPT_WORDS:
            self.old, self.young = self.young, {}
        ids = list(map(self.young.get, kinds))
        unseen = [i for i, found in enumerate(ids) if found is None]
        again = {kinds[i]: self.old[kinds[i]] for i in unseen if kinds[i] in self.old}
        self.young.update(again)
        again |= self.learn([kinds[i] for i in unseen if kinds[i] not in again])
        for i in unseen:
            ids[i] = again[kinds[i]]
        whole = pa.array(ids, pa.binary()).take(parts.indices)
        at = np.frombuffer(whole.buffers()[1], np.int32)[:len(whole) + 1] if len(whole) else np.zeros(1, np.int32)
        at = pa.py_buffer(np.ascontiguousarray(at[np.searchsorted(cuts, places)]))
        joined = pa.Array.from_buffers(pa.binary(), len(texts), [None, at, whole.buffers()[2] if len(whole) else pa.py_buffer(b"")])
        return pa.compute.binary_join_element_wise(joined, pa.scalar(end, pa.binary()), pa.scalar(b"", pa.binary()))

    def texts(self, texts: list[str], end: bytes) -> list[bytes]:
        return self.column(pa.array(texts, pa.string()), end).to_pylist()


def tokenize(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """(id, ids): little-endian unsigned 32-bit ids of each text, closed by ``end_id``."""
    end = int(end_id).to_bytes(4, "little")

    @F.arrow_udf("binary")
    def ids(column: pa.Array) -> pa.Array:
        codec = worker_state(("chunk-ids", tokenizer_path), lambda: ChunkIds(tokenizer_path))
        parts = [codec.column(run, end) for run in runs_of(column, RUN_BYTES)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.binary())

    return docs.select(F.col(id_col), ids(F.col(text_col)).alias("ids"))


def cut(tokenized: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: the columns of ``tokenized`` with the piece's own ids, and piece, start, length."""
    n = F.floor(F.octet_length("ids") / 4).cast("long")
    pieces = F.ceil(n / capacity)
    start = F.when(F.col("piece") == 0, F.lit(0).cast("long")).otherwise(F.col("first") + (F.col("piece") - 1) * capacity)
    length = F.when(F.col("piece") == 0, F.col("first")).otherwise(F.lit(capacity).cast("long"))
    others = [c for c in tokenized.columns if c != "ids"]
    return (
        tokenized.select(*others, "ids", (n - (pieces - 1) * capacity).alias("first"), F.explode(F.sequence(F.lit(0), pieces.cast("int") - 1)).alias("piece"))
        .select(*others, "ids", "piece", start.alias("start"), length.alias("length"))
        .withColumn("ids", F.substring("ids", (F.col("start") * 4 + 1).cast("int"), (F.col("length") * 4).cast("int")))
    )


def stored_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of ``docs`` with a check sum in place of their ids, as a stored table.

    ``pack`` numbers pieces in Python too: in one stage with it, a worker would tokenize in one task and number in the next, and
    learn its words anew each time.
    """
    pieces = cut(tokenize(docs, tokenizer_path), capacity)
    return materialize(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "cut")


# ---- the plan, on the histogram ------------------------------------------------------------------------------

def best_fillings(value: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Knapsack table: the best value of each room, and the length taken first in it (0: leave one place empty)."""
    best, take = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        sums = best[room - 1::-1][:room] + value[1:room + 1]
        k = int(sums.argmax())
        if sums[k] > best[room - 1]:
            best[room], take[room] = sums[k], k + 1
        else:
            best[room] = best[room - 1]
    return best, take


def _filling(take: np.ndarray, room: int, lengths: list[int]) -> Counter:
    found = Counter(lengths)
    while room > 0:
        if take[room]:
            found[int(take[room])] += 1
            room -= int(take[room])
        else:
            room -= 1
    return found


def fractional(counts: np.ndarray, capacity: int, rounds: int = ROUNDS, fillings: int = FILLINGS) -> dict[tuple, float]:
    """Multiplicative weights for the covering program: {filling: how often}."""
    lengths = np.flatnonzero(counts)
    covered = np.zeros(capacity + 1)
    used: dict[tuple, float] = {}
    for _ in range(rounds):
        share = np.zeros(capacity + 1)
        share[lengths] = covered[lengths] / counts[lengths]
        short = lengths[share[lengths] < 1]
        if not len(short):
            break
        # the price of a place falls with cover; lengths beyond their count are worth little
        value = np.zeros(capacity + 1)
        value[lengths] = lengths * np.exp(-RATE * share[lengths])
        best, take = best_fillings(value, capacity)
        worth = value[short] + best[capacity - short]
        order = short[np.argsort(-worth, kind="stable")][:fillings]
        for s in order.tolist():
            if covered[s] >= counts[s]:
                continue
            found = _filling(take, capacity - s, [s])
            parts = np.array(list(found)), np.array(list(found.values()))
            step = float((counts[parts[0]] / parts[1]).min())
            step = max(step / 2, min(step, 1.0))
            key = tuple(sorted(found.items(), reverse=True))
            used[key] = used.get(key, 0.0) + step
            covered[parts[0]] += step * parts[1]
    return used


def best_fit(counts: np.ndarray, capacity: int) -> Counter:
    """Best fit in decreasing order: {filling: how often}."""
    rooms: dict[int, list[list[int]]] = {}
    mask, sealed = 0, []
    for s in np.flatnonzero(counts)[::-1].tolist():
        for _ in range(int(counts[s])):
            fits = mask >> s
            if fits:
                room = s + (fits & -fits).bit_length() - 1
                filling = rooms[room].pop()
                if not rooms[room]:
                    mask ^= 1 << room
            else:
                room, filling = capacity, []
            filling.append(s)
            room -= s
            if room:
                rooms.setdefault(room, []).append(filling)
                mask |= 1 << room
            else:
                sealed.append(filling)
    return Counter(tuple(sorted(Counter(f).items(), reverse=True)) for f in sealed + [f for fs in rooms.values() for f in fs])


def many_at_once(left: np.ndarray, capacity: int, most: int) -> Counter:
    """Best fit by whole counts until at most ``most`` pieces are left (``left`` is lowered).

    A filling takes the longest piece, then again the longest that fits, and is used as often as its lengths allow; each use
    exhausts a length or brings it below what one filling takes, so a few thousand steps are enough for any corpus.
    """
    found: Counter = Counter()
    while left.sum() > most:
        filling, room, free = Counter(), capacity, left.copy()
        while room > 0 and len(fits := np.flatnonzero(free[:room + 1])):
            s = int(fits[-1])
            filling[s] += 1
            free[s] -= 1
            room -= s
        often = min(int(left[s]) // a for s, a in filling.items())
        found[tuple(sorted(filling.items(), reverse=True))] += often
        for s, a in filling.items():
            left[s] -= often * a
    return found


def solve(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[tuple, int]]:
    """[(filling, how often)], holding every length exactly as often as it is counted.

    ``counts[s]`` pieces have length s. Different fillings are bounded by len(SLACKS) * ROUNDS * FILLINGS, those of
    ``many_at_once`` and LAST_STEP of the last step, whatever the counts are.
    """
    left = counts.astype(np.int64).copy()
    plan: Counter = Counter()
    if left[capacity]:
        plan[((capacity, 1),)] = int(left[capacity])
        left[capacity] = 0
    # short pieces held back let the last step close its gaps
    spare = np.where(np.arange(capacity + 1) <= capacity // 4, left // 4, left // 20)
    spare = (spare * min(1.0, LAST_STEP / 2 / max(1, int(spare.sum())))).astype(np.int64)
    left -= spare
    best: tuple[int, Counter, Counter] | None = None
    for slack in SLACKS:
        used = fractional(left, capacity)
        fill = {k: sum(s * a for s, a in k) for k in used}
        for key in sorted(used, key=lambda k: (-fill[k], -used[k], k)):
            if fill[key] < capacity - slack:
                break
            often = min([round(used[key] + 0.25), *(int(left[s]) // a for s, a in key)])
            if often > 0:
                plan[key] += often
                for s, a in key:
                    left[s] -= often * a
        if left.sum() > LAST_STEP:
            if slack < SLACKS[-1]:
                continue
            plan.update(many_at_once(left, capacity, LAST_STEP // 2))
        rest = best_fit(left + spare, capacity)
        total = sum(plan.values()) + sum(rest.values())
        if best is None or total <= best[0]:
            best = total, plan.copy(), rest
    total, fixed, _ = best
    least = -(-int((counts * np.arange(capacity + 1)).sum()) // capacity)
    for share in RELEASED:
        if total == least:
            break
        held = Counter({k: n if k[0][0] == capacity else n - int(n * share + 0.5) for k, n in fixed.items()})
        loose = counts.astype(np.int64).copy()
        for key, n in held.items():
            for s, a in key:
                loose[s] -= n * a
        if loose.sum() <= LAST_STEP:
            other = best_fit(loose, capacity)
            if (now := sum(held.values()) + sum(other.values())) < total:
                total, best = now, (now, held, other)
    plan = +best[1] + best[2]
    return sorted(plan.items(), key=lambda x: (-sum(s * a for s, a in x[0]), x[0]))


def plan_rows(plan: list[tuple[tuple, int]]) -> dict[str, np.ndarray]:
    """By length and first number: which numbers of a length fill which sequences, and where in them."""
    rows, numbered, sequence = [], Counter(), 0
    for filling, often in plan:
        at = 0
        for s, a in filling:
            rows.append((s, numbered[s], a, sequence, at))
            numbered[s] += a * often
            at += s * a
        sequence += often
    rows.sort()
    names = ("length", "first", "each", "sequence", "at")
    return {n: np.array(c, np.int64) for n, c in zip(names, zip(*rows) if rows else ((),) * 5)}


def _numbered(schema: T.StructType):
    at = schema.fieldNames().index("length")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        release_worker_state()
        task, seen = TaskContext.get().partitionId(), np.zeros(1, np.int64)
        for batch in batches:
            lengths = batch.column(at).to_numpy(zero_copy_only=False)
            if not len(lengths):
                continue
            if lengths.max() >= len(seen):
                seen = np.concatenate((seen, np.zeros(int(lengths.max()) + 1 - len(seen), np.int64)))
            order = np.argsort(lengths, kind="stable")
            kinds, starts, sizes = np.unique(lengths[order], return_index=True, return_counts=True)
            numbers = np.empty(len(lengths), np.int64)
            numbers[order] = np.arange(len(lengths)) - np.repeat(starts - seen[kinds], sizes)
            seen[kinds] += sizes
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(lengths), task, np.int64)), pa.array(numbers)], names=[*batch.schema.names, "_task", "_number"]
            )

    return number


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add (or replace) sequence_id and offset of rows with a ``length`` of 1 to ``capacity``; all other columns are carried along."""
    pieces = pieces.drop("sequence_id", "offset")
    names = pieces.columns
    # names of our own, so that no column of the input clashes with what is worked out on the way
    pieces = pieces.toDF(*["length" if c == "length" else f"c{i}" for i, c in enumerate(names)])
    schema = T.StructType(list(pieces.schema) + [T.StructField("_task", T.LongType()), T.StructField("_number", T.LongType())])
    held = materialize(pieces.mapInArrow(_numbered(pieces.schema), schema), "pieces")
    by_task = materialize(held.groupBy("_task", "length").agg(F.count("*").alias("n")), "lengths")
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in by_task.groupBy("length").agg(F.sum("n")).collect():  # at most ``capacity`` rows
        counts[length] = n
    plan = plan_rows(solve(counts, capacity))
    shift = 1 << 40
    keys = plan["length"] * shift + plan["first"]

    @F.arrow_udf("sequence_id long, offset long")
    def place(length: pa.Array, number: pa.Array) -> pa.Array:
        release_worker_state()
        s, k = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in (length, number))
        row = np.searchsorted(keys, s * shift + k, side="right") - 1
        copy, nth = np.divmod(k - plan["first"][row], plan["each"][row])
        return pa.StructArray.from_arrays([pa.array(plan["sequence"][row] + copy), pa.array(plan["at"][row] + nth * s)], ["sequence_id", "offset"])

    before = F.sum("n").over(Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    firsts = by_task.select("_task", "length", F.coalesce(before, F.lit(0)).alias("_first"))
    return (
        held.join(firsts, ["_task", "length"]).withColumn("_place", place(F.col("length"), F.col("_number") + F.col("_first")))
        .select(*pieces.columns, "_place.sequence_id", "_place.offset").toDF(*names, "sequence_id", "offset")
    )


@query("op3_packing")
def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = stored_pieces(table(spark, folder, "documents"), vocabulary_path("byte_bpe_50k.json"))
    return pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
