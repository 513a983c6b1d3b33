"""Token ids and counts against the library on whole texts; round trips of coded files."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from corbel.llm import queries, rangecoder, tokencount
from corbel.llm.tokens import ByteEncoder, byte_encoder, tokenizer, vocabulary_path, word_encoder

BYTES, WORDS = (vocabulary_path(x) for x in (queries.BYTE_VOCABULARY, queries.WORD_VOCABULARY))
SF_DIR = "/root/testdata/sf0.001"

ODD = [
    "a<|endoftext|>b  <|endoftext|>",
    "  \n's x\n\n  don't'll  \t'reX",
    "ΑΣ İ ǅ é é ' 's",
    "😀😀 　漢字かな한국어",
    "x" * 500,
    " " * 300 + "a",
    "\r\n\r\n\tfoo_bar 12345 <|startoftext|>!!<|endoftext|",
    "=" * 70,
    "<|endoftext|>",
    "",
]


def made(count, seed):
    chance = random.Random(seed)
    letters = [*"abcs'treXl d  \n\t!?#09_éßΣ漢😀 ́ ", "<|endoftext|>", "'re", "'s"]
    return ["".join(chance.choices(letters, k=chance.randrange(1, 60))) for _ in range(count)]


@pytest.mark.parametrize("path,encoder", [(BYTES, byte_encoder), (WORDS, word_encoder)])
def test_ids_are_the_librarys(path, encoder):
    for text in ODD + made(500, 1):
        found = np.frombuffer(encoder(path).encode(text), "<u2").tolist()
        assert found == tokenizer(path).encode(text, add_special_tokens=False).ids, text


def test_every_code_point_is_cut_alike():
    for first in range(0, 0x110000, 0x400):
        if 0xD800 <= first < 0xE000:
            continue
        text = "".join(f"a{chr(c)}1{chr(c)}!" for c in range(first, first + 0x400))
        found = np.frombuffer(byte_encoder(BYTES).encode(text), "<u2").tolist()
        assert found == tokenizer(BYTES).encode(text, add_special_tokens=False).ids, hex(first)


def test_counts_of_every_prefix():
    counter = tokencount.counter(BYTES)
    for text in ODD + made(150, 2):
        found = np.cumsum(np.frombuffer(counter.steps(text), np.int8), dtype=int).tolist()
        wanted = [
            len(tokenizer(BYTES).encode(text[: n + 1], add_special_tokens=False).ids)
            for n in range(len(text))
        ]
        assert found == wanted, text


@pytest.mark.parametrize(
    "text", [" word" * 500 + "<|endoftext|> tail", "a b<|endoftext|>" * 3000, "<|endoftext|>" * 3000]
)
def test_special_strings_in_long_texts(text):
    found = np.cumsum(np.frombuffer(tokencount.counter(BYTES).steps(text), np.int8), dtype=int)
    assert len(found) == len(text)
    ends = {*range(0, len(text), 997), *range(len(text) - 40, len(text)), *range(2490, 2530)}
    for n in sorted(n for n in ends if n < len(text)):
        wanted = len(tokenizer(BYTES).encode(text[: n + 1], add_special_tokens=False).ids)
        assert found[n] == wanted, n


def test_prefix_questions(spark):
    texts = [(1, "Hello there, world"), (2, None), (3, "")]
    df = spark.createDataFrame(texts, "doc_id bigint, text string").withColumn("n_bytes", F.lit("x"))
    counted = tokencount.prefix_counts(df, BYTES)
    assert counted.columns == ["doc_id", "text", "n_bytes", "n_tokens", "token_steps"]
    asked = counted.select(
        "doc_id",
        "n_tokens",
        tokencount.tokens_at(F.col("token_steps"), F.lit(5)).alias("at"),
        tokencount.fitting(F.col("token_steps"), F.lit(2)).alias("fits"),
    )
    # " there" is one token, so is "Hello"; the longest prefix of two tokens ends before the comma.
    assert sorted(map(tuple, asked.collect())) == [(1, 4, 1, 11), (2, 0, 0, 0), (3, 0, 0, 0)]


def test_count_query_is_the_librarys(spark):
    texts = queries.read(spark, SF_DIR, "documents").select("doc_id", "text").collect()
    found = {r.doc_id: r for r in queries.op3_prefix_token_counts(spark, SF_DIR).collect()}
    assert len(found) == len(texts)
    for row in texts:
        n = len(tokenizer(BYTES).encode(row.text, add_special_tokens=False).ids)
        assert tuple(found[row.doc_id]) == (row.doc_id, len(row.text.encode()), n, n > 512)


@pytest.mark.parametrize("count", [0, 1, 2, 255, 256, 257, 3000, 70_001])
@pytest.mark.parametrize("kind", ["one", "few", "all"])
def test_coded_ids_round_trip(count, kind):
    chance = np.random.default_rng(count)
    ids = {
        "one": np.zeros(count, np.int64),
        "few": np.minimum(chance.zipf(1.3, count), 60_000),
        "all": chance.integers(0, 65_536, count),
    }[kind]
    data = rangecoder.encode_ids(ids, 65_536)
    assert (rangecoder.decode_ids(data, count, 65_536) == ids).all()
    if kind == "one" and count > 3000:
        assert len(data) < count / 2


def test_damage_is_found():
    block = rangecoder.pack_block([(7, np.arange(50, dtype="<u2").tobytes())], 100)
    assert rangecoder.unpack_block(block)[0] == [7]
    for at in (0, 30, len(block) - 1):
        hurt = bytearray(block)
        hurt[at] ^= 1
        with pytest.raises(ValueError):
            rangecoder.unpack_block(bytes(hurt))


def digest(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_file_query(spark):
    texts = queries.read(spark, SF_DIR, "documents").orderBy("doc_id").collect()
    found = queries.op1_token_id_files(spark, SF_DIR).orderBy("doc_id").collect()
    start = 0
    assert len(found) == len(texts)
    for row, text in zip(found, texts):
        ids = tokenizer(BYTES).encode(text.text, add_special_tokens=False).ids + [0]
        assert tuple(row) == (text.doc_id, start, len(ids), digest(ids))
        start += len(ids)


def test_files_of_odd_tables(spark):
    rows = [(5, "b"), (None, "n"), (5, "b"), (-1, None), (5, "a"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("key", F.lit(1))
    read = rangecoder.read_ids(rangecoder.write_ids(df, BYTES)).orderBy("start").collect()
    assert [r.key for r in read] == [None, None, -1, 5, 5, 5]
    sizes = [r.n_tokens for r in read]
    assert sorted(sizes[:2]) == [1, 2] and sizes[2:] == [1, 2, 2, 2]
    assert [r.start for r in read] == [sum(sizes[:i]) for i in range(6)]
    empty = df.where("false")
    assert rangecoder.read_ids(rangecoder.write_ids(empty, BYTES)).count() == 0


@pytest.mark.parametrize("path,encoder", [(BYTES, byte_encoder), (WORDS, word_encoder)])
def test_cuts_at_white_space_change_no_id(path, encoder):
    parts = [" ", "  ", "\n", " \n", "\t", "\x1c", "\0", " ", "\r\n", "a", "Σ", "9", "'s", ",",
             "<|endoftext|>", "漢"]
    pick = np.random.default_rng(5)
    texts = ["".join(parts[i] for i in pick.integers(0, len(parts), 12)) for _ in range(5000)]
    library = tokenizer(path).encode_batch_fast(texts, add_special_tokens=False)
    own = encoder(path)
    assert [np.frombuffer(own.encode(x), "<u2").tolist() for x in texts] == [x.ids for x in library]


@pytest.mark.parametrize("path,encoder", [(BYTES, byte_encoder), (WORDS, word_encoder)])
def test_each_character_around_the_latin_letters(path, encoder):
    """Pieces on both sides of the border up to which the model alone is asked."""
    texts = [f"ab{c}cd {c} {c}{c}E{c}" for c in map(chr, range(0x270))]
    whole = tokenizer(path).encode_batch_fast(texts, add_special_tokens=False)
    for text, wanted in zip(texts, whole):
        assert np.frombuffer(encoder(path).encode(text), "<u2").tolist() == wanted.ids, ascii(text)


def test_words_are_merged_as_the_library_merges_them():
    """Merging by rank gives the library's ids for words of a corpus and for made-up ones."""
    import duckdb

    path, rng = vocabulary_path("word_bpe_49k.json"), random.Random(11)
    texts = duckdb.sql("SELECT text FROM '/root/testdata/sf0.01/documents.parquet'").fetchall()
    words = {x.lower() for (text,) in texts for x in (text or "").split()}
    letters = ["abcdefghijklmnopqrstuvwxyz", "éèàùöäüßçñœæ\u0130aeiou", "日本한국ёжش🙂ab", "!?#$%&()*+-./:;<=>@~0123"]
    words |= {"".join(rng.choices(rng.choice(letters), k=rng.randint(1, 14))) for _ in range(40_000)}
    words |= {"a" * 5000, "ab" * 3000}
    words = sorted(words)
    encoder = word_encoder(path)
    encoded = tokenizer(path).encode_batch(words, add_special_tokens=False)
    for word, want in zip(words, encoded):
        assert np.frombuffer(encoder.encode(word), "<u2").tolist() == want.ids, word


def test_a_full_block_comes_back():
    """A block of the size that files hold, with its last lane short."""
    chance = np.random.default_rng(8)
    ids = np.minimum(chance.zipf(1.3, rangecoder.BLOCK_IDS + 77), 50_000).astype("<u2")
    docs = [(n, x.tobytes()) for n, x in enumerate(np.array_split(ids, 300))]
    names, sizes, found = rangecoder.unpack_block(rangecoder.pack_block(docs, 50_257))
    assert names == list(range(300)) and sizes.sum() == len(ids) and (found == ids).all()


def test_files_at_a_target(spark, tmp_path, monkeypatch):
    """Blocks written to a folder of the caller's are read from there, several to a part."""
    monkeypatch.setattr(rangecoder, "BLOCK_IDS", 50)
    rows = [(n % 40, f"some words of text {n} " * (n % 9)) for n in range(120)] + [(None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    target = str(tmp_path / "ids")
    written = rangecoder.write_ids(df, BYTES, target=target)
    assert written.count() > written.select("part").distinct().count()
    found = rangecoder.read_ids(spark.read.parquet(target)).orderBy("start").collect()
    assert [r.key for r in found] == sorted([k for k, _ in rows], key=lambda k: (k is not None, k))
    assert [r.start for r in found] == [0, *np.cumsum([r.n_tokens for r in found])[:-1]]
    with pytest.raises(Exception, match="already exists"):
        rangecoder.write_ids(df, BYTES, target=target)


def test_blocks_are_coded_as_before():
    """Files that an earlier version wrote stay readable: the same bytes for the same ids."""
    at = np.arange(70_001)
    ids = at * at // 7 % 911 * (at % 3)
    assert zlib.crc32(rangecoder.encode_ids(ids, 50_257)) == 1464646868


def test_only_ids_that_no_order_predicts_are_searched(monkeypatch):
    """Decoding looks up few ids among the frequencies where most are predicted."""
    ids = np.tile(np.arange(300), 700)
    data, search, asked = rangecoder.encode_ids(ids, 50_257), np.searchsorted, []

    def counted(table, points, **rest):
        asked.append(len(points))
        return search(table, points, **rest)

    monkeypatch.setattr(np, "searchsorted", counted)
    assert (rangecoder.decode_ids(data, len(ids), 50_257) == ids).all()
    assert sum(asked) < len(ids) / 4


@pytest.mark.parametrize("most", [1, 3, 2_000])
def test_guided_lookups_are_searches(most):
    """Each place of the frequencies, few and many to an id, also past the guide's last step."""
    model = rangecoder.Model(2_000, 1)
    model.counts += np.random.default_rng(most).integers(0, most, 2_000, dtype=np.int32)
    model.predict(1)
    places = np.arange(model.below[-1], dtype=np.int32)
    assert (model._holding(places) == np.repeat(np.arange(2_000), model.freq)).all()
    few = places[-100:]
    assert (model._holding(few) == np.searchsorted(model.below, few, side="right") - 1).all()


def test_white_space_that_meets_is_looked_ahead_of():
    """Only where two characters of white space meet is the slower pattern used; ids are the same."""
    own, asked = ByteEncoder(BYTES), []
    ahead = own._ahead
    own._ahead = lambda text: asked.append(text) or ahead(text)
    blanks = [chr(c) for c in range(0x3100) if chr(c).isspace()] + ["\u180e", "\u200b", "\0"]
    texts = [f"{y}a{x}b {x}c{x}\nd{x}{y}{x}e{x}" for x in blanks for y in blanks]
    single = [f"one{x}two{x}" for x in blanks] + ["a b c.\nd, e\tf"]
    library = tokenizer(BYTES).encode_batch_fast(texts + single, add_special_tokens=False)
    found = [np.frombuffer(own.encode(x), "<u2").tolist() for x in texts + single]
    assert found == [x.ids for x in library]
    assert asked and not {*asked} & {*single}
