"""Words that differ by one letter, grouped under their frequent spellings.

Two words one error apart agree in a half of the longer one: before the error or
after it. Words meet by that half, hashed into bins of bounded size. A bin's words,
delimited, are indexed by suffix ranks from either side (:class:`Suffixes`, of the
words as they are or reversed), and every word asks: its half is matched exactly from
the delimiter on, then the rank interval is extended letter by letter across the other
half, allowing one error. A word is asked for with one letter replaced or left out; the
added letter is the other word's letter left out.

A half that very many words share is held in several blocks, and its words ask in each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corbel.llm.common import importable, quoted, settle

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH, LEAST_COUNT = 7, 2
#: A word in this many runs loses a letter, chosen by the same hash.
DAMAGED = 31
#: So many times as frequent is the spelling that a word is a form of.
RATIO = 10

#: Letters in a bin, about, and words of one half in a block.
BIN_LETTERS, BLOCK_WORDS = 1 << 20, 1 << 16
#: Words that ask at a time.
ASKING = 1 << 14


def vocabulary(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word`` and ``n``, its occurrences, of words of seven letters or more that occur twice.

    Words are runs of Latin letters; only A-Z are lowered. A run loses a letter where the
    crc32 of ``doc_id:run`` is divisible by 31. A null id reads as empty, a null text has no
    word, and repeated rows count each.
    """
    runs = df.select(
        F.coalesce(quoted(doc_id).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(quoted(text), F.lit(RUN), F.lit(0))).alias("run"),
    ).where(F.length("run") >= LEAST_LENGTH)
    words = runs.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    hashed = words.select("run", F.crc32(F.concat_ws(":", "id", "run")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(
        F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run"))
    )
    return (
        hashed.select(F.when(F.col("h") % DAMAGED == 0, less).otherwise(F.col("run")).alias("word"))
        .where(F.length("word") >= LEAST_LENGTH)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= LEAST_COUNT)
    )


class Suffixes:
    """Suffix ranks of distinct words, each followed by a delimiter (0, the smallest symbol).

    ``keys`` holds symbol * size + row, sorted, for the symbol before each row's suffix: the
    place of ``c * size + row`` among them is the rank that ``row`` gets when ``c`` is put before.
    """

    def __init__(self, words: list[np.ndarray]):
        lengths = np.array([len(x) for x in words], np.int64)
        flat = np.concatenate(words) if words else np.zeros(0, np.int64)
        self.letters = np.unique(flat)
        ends = np.cumsum(lengths + 1)
        self.starts, self.size, self.n = ends - lengths - 1, int(ends[-1]) if len(ends) else 0, len(words)
        symbols = np.zeros(self.size, np.int64)
        inside = np.ones(self.size, bool)
        inside[ends - 1] = False
        symbols[inside] = self.codes(flat)
        self.sigma = len(self.letters) + 1
        self.rows = self._sorted(symbols, np.repeat(ends, lengths + 1) - np.arange(self.size))
        self.before = symbols[self.rows - 1]
        self.keys = np.sort(self.before * self.size + np.arange(self.size))

    def codes(self, points: np.ndarray) -> np.ndarray:
        """1, 2, ... for the words' letters in order; one more for any other."""
        at = np.searchsorted(self.letters, points)
        known = self.letters[np.minimum(at, len(self.letters) - 1)] == points if len(self.letters) else False
        return np.where(known, at, len(self.letters)) + 1

    def _sorted(self, symbols: np.ndarray, left: np.ndarray) -> np.ndarray:
        """Suffixes in order, each up to its delimiter (``left`` symbols); equal ones by place."""
        bits = self.sigma.bit_length()
        span = min(62 // bits, int(left.max(initial=1)))
        padded = np.concatenate([symbols, np.zeros(span, np.int64)])
        keys = np.zeros(self.size, np.int64)
        for i in range(span):
            keys = (keys << bits) | np.where(left > i, padded[i : i + self.size], 0)
        ranks = np.unique(keys, return_inverse=True)[1]
        while span < left.max(initial=0):
            further = np.zeros(self.size, np.int64)
            more = np.flatnonzero(left > span)
            further[more] = ranks[more + span] + 1
            ranks = np.unique(ranks * (self.size + 1) + further, return_inverse=True)[1]
            span *= 2
        return np.argsort(ranks, kind="stable")

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Rank intervals with a symbol put before."""
        base = symbol * self.size
        return np.searchsorted(self.keys, base + low), np.searchsorted(self.keys, base + high)

    def preceding(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Interval number and symbol of all letters that come before an interval's suffixes."""
        sizes = high - low
        wide = np.flatnonzero(sizes >= self.sigma)
        few = np.flatnonzero(sizes < self.sigma)
        many = sizes[few]
        rows = np.repeat(low[few] - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
        cells = np.unique(np.repeat(few, many) * self.sigma + self.before[rows])
        narrow, symbol = np.divmod(cells, self.sigma)
        letters = np.arange(1, self.sigma)
        at = np.concatenate([narrow, np.repeat(wide, len(letters))])
        symbol = np.concatenate([symbol, np.tile(letters, len(wide))])
        return at[symbol > 0], symbol[symbol > 0]

    def whole(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which intervals hold a suffix that is a whole word, and that word's number."""
        first, last = np.searchsorted(self.keys, low), np.searchsorted(self.keys, high)
        last = np.minimum(last, self.n)  # a delimiter precedes as many rows as there are words
        found = np.flatnonzero(first < last)
        return found, np.searchsorted(self.starts, self.rows[self.keys[first[found]]])


def one_error(held: list[np.ndarray], asking: list[np.ndarray], fixed: np.ndarray):
    """Pairs (asking, held) of words where one letter of the asking, before its last ``fixed``, is another or missing.

    Words are arrays of code points, those held are distinct.
    """
    index = Suffixes(held)
    found = [np.zeros((2, 0), np.int64)]
    for first in range(0, len(asking), ASKING):
        some = asking[first : first + ASKING]
        pairs = _asked(index, some, fixed[first : first + ASKING])
        found.append(pairs + np.array([[first], [0]]))
    return np.concatenate(found, axis=1)


def _asked(index: Suffixes, words: list[np.ndarray], fixed: np.ndarray) -> np.ndarray:
    lengths = np.array([len(x) for x in words], np.int64)
    symbols = index.codes(np.concatenate(words))
    ends = np.cumsum(lengths)
    word = np.arange(len(words))
    low, high = np.zeros(len(words), np.int64), np.full(len(words), index.n)

    def step(word, low, high, at):
        """The intervals with the words' letters ``at`` before them, where any suffix is left."""
        low, high = index.extend(symbols[(ends - lengths)[word] + at], low, high)
        some = low < high
        return word[some], low[some], high[some], at[some] - 1

    at = lengths - 1
    for done in range(int(fixed.max(initial=0))):  # the half that has no error
        now = fixed[word] > done
        rest = [x[~now] for x in (word, low, high, at)]
        moved = step(*(x[now] for x in (word, low, high, at)))
        word, low, high, at = (np.concatenate([x, y]) for x, y in zip(rest, moved))
    pairs = []
    while len(word):  # the other half, with an error at this letter or further on
        some = at >= 0
        word, low, high, at = word[some], low[some], high[some], at[some]
        which, symbol = index.preceding(low, high)
        other = symbol != symbols[(ends - lengths)[word[which]] + at[which]]
        which, symbol = which[other], symbol[other]
        new_low, new_high = index.extend(symbol, low[which], high[which])
        some = new_low < new_high
        erred = [
            np.concatenate([word, word[which[some]]]),
            np.concatenate([low, new_low[some]]),
            np.concatenate([high, new_high[some]]),
            np.concatenate([at, at[which[some]]]) - 1,
        ]
        while len(erred[0]):
            over = erred[3] < 0
            ended, number = index.whole(erred[1][over], erred[2][over])
            pairs.append(erred[0][over][ended] * index.n + number)
            erred = step(*(x[~over] for x in erred))
        word, low, high, at = step(word, low, high, at)
    cells = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
    return np.stack(np.divmod(cells, max(1, index.n)))


def _points(words: pa.Array, reverse: bool) -> list[np.ndarray]:
    arrays = [np.frombuffer(x.encode("utf-32-le"), np.uint32).astype(np.int64) for x in words.to_pylist()]
    return [x[::-1] for x in arrays] if reverse else arrays


def entries(words: DataFrame, bins: int, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Rows (``bin``, ``backwards``, ``word``, ``n``, ``fixed``, ``holds``, ``asks``): who meets in which bin.

    Pairs whose longer word has l letters meet by its first l div 2 letters (words are then
    read backwards) or by the others. A word is the longer or an equal one for its own length,
    and the shorter for one more.
    """
    length = F.length("word")
    ways = F.array(
        *[
            F.struct(
                F.lit(backwards).alias("backwards"),
                (length + more).alias("longer"),
                fixed.cast("int").alias("fixed"),
                half.alias("half"),
                F.lit(more == 0).alias("asks"),
            )
            for more in (0, 1)
            for middle in [F.floor((length + more) / 2).cast("int")]
            for backwards, fixed, half in (
                (True, middle, F.substring("word", F.lit(1), middle)),
                (False, length + more - middle,
                 F.substring("word", middle - more + 1, length)),
            )
        ]
    )
    key = ["backwards", "longer", "half"]
    all_ = words.select("word", "n", F.inline(ways))
    crowds = (
        all_.groupBy(*key)
        .agg(F.count("*").alias("crowd"))
        .where(F.col("crowd") > block_words)
        .select(*key, F.ceil(F.col("crowd") / block_words).cast("int").alias("blocks"))
    )
    placed = all_.join(crowds, key, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    home = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    visits = F.when(F.col("asks"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(home))
    spread = placed.withColumn("home", home).withColumn("block", F.explode(visits))
    number = F.pmod(F.xxhash64(*key, "block"), F.lit(bins))
    return spread.select(
        F.when(F.col("backwards"), number + bins).otherwise(number).alias("bin"),
        "backwards", "word", "n", "fixed", (F.col("block") == F.col("home")).alias("holds"), "asks",
    )


_PAIR = T.StructType(
    [
        T.StructField("word", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("near", T.StringType()),
        T.StructField("near_n", T.LongType()),
    ]
)


def near_words(words: DataFrame, bin_letters: int = BIN_LETTERS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """All pairs of ``words`` (``word`` distinct, ``n``) one error apart, from both ends: ``word``, ``n``, ``near``, ``near_n``.

    One error is one letter replaced, added or left out.
    """
    letters = words.agg(F.sum(F.length("word"))).first()[0] or 0
    bins = max(1, -(-2 * letters // bin_letters))
    arrow = to_arrow_schema(_PAIR)

    def run(group: pa.Table) -> pa.Table:
        backwards = group["backwards"][0].as_py()
        holds = group.filter(group["holds"]).select(["word", "n"])
        holds = holds.group_by("word").aggregate([("n", "min")])
        asks = group.filter(group["asks"])
        at, number = one_error(
            _points(holds["word"], backwards),
            _points(asks["word"], backwards),
            asks["fixed"].to_numpy(),
        )
        one = [asks[x].take(pa.array(at)) for x in ("word", "n")]
        two = [holds[x].take(pa.array(number)) for x in ("word", "n_min")]
        shorter = pc.less(pc.utf8_length(two[0]), pc.utf8_length(one[0]))
        forth = pa.Table.from_arrays([*one, *two], schema=arrow)
        back = pa.Table.from_arrays([*two, *one], schema=arrow).filter(shorter)
        return pa.concat_tables([forth, back])

    met = entries(words, bins, block_words).groupBy("bin").applyInArrow(run, _PAIR)
    # A pair whose error lies at the middle, in equal letters, is found from both halves.
    return met.distinct()


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the end of its chain, of ``forms`` (``word``, ``form``).

    A form is ten times as frequent as its word, so chains are short; their lengths halve in
    each round, and each round is written.
    """
    ends = settle(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        next_ = ends.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = settle(ends.join(next_, "root", "left"), "roots")
        ends = joined.select("word", F.coalesce("further", "root").alias("root"))
        if joined.where("further IS NOT NULL").isEmpty():
            return ends


def spelling_groups(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every word of :func:`vocabulary` with its frequent spelling.

    Returns ``word``, ``n``, ``n_near`` (words one error apart), ``form`` (the most frequent
    of these, the first in code-point order of equally frequent ones, if it is ten times as
    frequent as the word), ``form_n`` (its count; both else null) and ``root`` (the form of
    the form and so on, or the word). Other columns of the documents play no part; an empty
    table, or one without words, gives no row.
    """
    importable(df.sparkSession)
    words = settle(vocabulary(df, doc_id, text), "vocabulary")
    best = near_words(words).groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"),
    )
    joined = words.join(best, "word", "left")
    enough = -F.col("best.less") >= RATIO * F.col("n")
    judged = settle(
        joined.select(
            "word", "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(enough, F.col("best.near")).alias("form"),
            F.when(enough, -F.col("best.less")).alias("form_n"),
        ),
        "spellings",
    )
    return judged.join(roots(judged.where("form IS NOT NULL")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
