import pytest
from pyspark.sql import functions as F

from pairmine.functions import text
from pairmine.operators import encoding, split, subwords, vocabulary
from pairmine.operators.vocabulary import CLS_ID, IMG_ID, PAD_ID, SEP_ID


def coded(spark, before, after, alt):
    df = spark.createDataFrame(
        [("1", before, after, alt)], "context_id string, b string, a string, alt_text string"
    )
    df = vocabulary.hashed_ids(df, ["b", "a", "alt_text"])
    return df.select(
        "context_id",
        "alt_text",
        F.col("b_ids").alias("before_ids"),
        F.col("a_ids").alias("after_ids"),
        F.col("alt_text_ids").alias("alt_ids"),
        F.col("b_tokens").alias("before_tokens"),
        F.col("a_tokens").alias("after_tokens"),
    )


def train(spark, before, after, alt, max_len):
    return encoding.training_examples(coded(spark, before, after, alt), max_len).collect()


def words(n):
    return " ".join(f"word{i}" for i in range(n))


def test_basic(spark):
    row = train(spark, "Some text before.", "Some text after.", "the alt text", 64)[0]
    assert len(row.input_ids) == len(row.attention_mask) == 64
    assert row.true_start_token == 1 + 4
    assert row.true_end_token == row.true_start_token + 3 - 1
    assert row.attention_mask[row.true_end_token] == 1 and row.attention_mask[-1] == 0
    assert sum(row.attention_mask) == row.seq_len == 4 + 4 + 3
    assert row.input_ids[0] == CLS_ID and row.input_ids[5] == IMG_ID
    assert row.input_ids[10] == SEP_ID and set(row.input_ids[11:]) == {PAD_ID}


@pytest.mark.parametrize(
    "before, after, alt",
    [(words(300), "Short after.", "alt text here"), ("Short before.", words(300), "find this alt")],
)
def test_truncation(spark, before, after, alt):
    row = train(spark, before, after, alt, 128)[0]
    assert len(row.input_ids) == 128 and sum(row.attention_mask) <= 128
    assert 0 <= row.true_start_token <= row.true_end_token < 128
    # Unused room of one side does not go to the other.
    assert row.seq_len == 3 + min(62, len(before.split()) + before.count(".")) + min(
        63, len(after.split()) + after.count(".")
    )


def test_truncation_keeps_what_is_next_to_the_image(spark):
    df = coded(spark, words(300), words(300), "x y")
    row = encoding.encode_training(df, 13).join(df.drop("alt_text"), "context_id").first()
    assert row.sequence[1:6] == row.before_ids[-5:]
    assert row.sequence[7:12] == row.after_ids[:5]


def test_rejections(spark):
    long_alt = "This alt text is quite long and might be cut off depending on max_len"
    assert train(spark, "Very short before.", "Very short after.", long_alt, 32) == []
    reasons = {}
    for name, alt, max_len in [
        ("empty", "", 64), ("blank", "  ", 64), ("long", words(40), 32), ("outside", words(14), 64), ("ok", "a", 64),
    ]:
        out = encoding.encode_training(coded(spark, "Some", "Text", alt), max_len)
        reasons[name] = out.first().reject_reason
    assert reasons == {
        "empty": "empty_alt", "blank": "alt_without_tokens", "long": "alt_too_long",
        "outside": "span_outside_sequence", "ok": None,
    }


def test_end_may_fall_on_the_separator(spark):
    row = train(spark, "", "", "valid alt", 64)[0]
    assert (row.true_start_token, row.true_end_token, row.seq_len) == (1, 2, 3)
    assert train(spark, "", "", "a valid alt", 64) == []


def test_reject_counts_and_no_rows(spark):
    df = coded(spark, "a", "b", "c").unionByName(coded(spark, "a", "b", ""))
    counts = {r.reject_reason: r.examples for r in encoding.reject_counts(encoding.encode_training(df, 64)).collect()}
    assert counts == {"kept": 1, "empty_alt": 1}
    assert encoding.training_examples(df.filter("false"), 64).count() == 0


@pytest.mark.parametrize(
    "n_before, n_after, max_len, max_before, expected",
    [
        (300, 300, 128, 50, (50, 75)),
        (300, 300, 128, 250, (125, 0)),
        (10, 300, 128, 50, (10, 115)),
        (10, 10, 128, 50, (10, 10)),
        (10, 10, 4, 50, (1, 0)),
        (10, 10, 128, 0, (0, 10)),
        (0, 0, 128, 50, (0, 0)),
    ],
)
def test_inference_budget(spark, n_before, n_after, max_len, max_before, expected):
    df = coded(spark, words(n_before), words(n_after), "")
    row = encoding.inference_inputs(df, max_len, max_before).first()
    b, a = expected
    assert row.seq_len == b + a + 3 == len(row.sequence) == sum(row.attention_mask)
    assert row.sequence[1 : 1 + b] == (row.before_ids[-b:] if b else [])
    assert row.sequence[2 + b : 2 + b + a] == row.after_ids[:a]
    assert len(row.input_ids) == max_len
    assert len(row.sequence_tokens) == row.seq_len and row.sequence_tokens[1 + b] == "[IMG]"


def test_no_room_gives_no_row(spark):
    assert encoding.inference_inputs(coded(spark, "a", "b", ""), 3, 5).count() == 0


def test_vocabulary_and_both_ways_to_encode(spark):
    rows = [("1", "a b a. C", "d"), ("2", "", "a a"), ("3", None, "new é_1"), ("4", "a " * 50, "b")]
    df = spark.createDataFrame(rows, "k string, x string, y string")
    vocab = vocabulary.build_vocabulary(df, ["x", "y"]).cache()
    ids = {r.token: r.token_id for r in vocab.collect()}
    assert sorted(ids.values()) == list(range(5, 5 + len(ids)))
    assert {r.token: r.n for r in vocab.collect()}["a"] == 54
    extra = df.union(spark.createDataFrame([("5", "unseen", "a")], df.schema))
    small = vocabulary.encode_tokens(extra, "k", ["x", "y"], vocab)
    large = vocabulary.encode_tokens(extra, "k", ["x", "y"], vocab, vocabulary_rows=10**9, hot_tokens=2)
    a, b = (sorted(d.collect()) for d in (small, large))
    assert a == b and len(a) == 5
    assert a[0].x_ids == [ids[t] for t in ["a", "b", "a", ".", "c"]]
    assert (a[2].x_ids, a[1].x_ids, a[4].x_ids) == ([], [], [1])


def test_numbering_is_the_same_for_any_partitioning(spark):
    counts = spark.range(5000).select(F.concat(F.lit("t"), "id").alias("token"), F.lit(1).alias("n"))
    one = {tuple(r) for r in vocabulary.number_tokens(counts.repartition(1)).collect()}
    many = {tuple(r) for r in vocabulary.number_tokens(counts.repartition(9)).collect()}
    assert one == many and {t[2] for t in one} == set(range(5, 5005))


@pytest.mark.parametrize("n, share, expected", [(0, 0.2, 0), (1, 0.2, 1), (2, 0.99, 1), (10, 0.2, 8), (1000, 0.15, 850), (7, 0, 7), (5, 0.001, 4)])
def test_split_sizes(spark, n, share, expected):
    df = spark.range(n)
    parts = split.train_validation_split(df, "id", share).collect()
    assert len(parts) == n
    assert sum(r.part == "train" for r in parts) == expected
    again = split.train_validation_split(df.repartition(5), "id", share).collect()
    assert sorted(parts) == sorted(again)


def test_example_limit(spark):
    df = spark.range(20)
    assert [r.id for r in split.limit_examples(df, ["id"], 3).collect()] == [0, 1, 2]
    assert split.limit_examples(df, ["id"], None).count() == 20


def test_tokenize(spark):
    df = spark.createDataFrame([("Été's a_b, c! x",)], "t string")
    assert df.select(text.tokenize(F.col("t"))).first()[0] == ["été", "'", "s", "a_b", ",", "c", "!", "x"]


def random_pieces(rng, letters="abcé"):
    pieces = {"".join(rng.choice(letters) for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(1, 40))}
    pieces |= {"##" + "".join(rng.choice(letters) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(40))}
    return [(p, 5 + i) for i, p in enumerate(sorted(pieces))]


def longest_first(word, known):
    """Try every end from the last one down, at every place."""
    out, start = [], 0
    while start < len(word):
        for end in range(len(word), start, -1):
            piece = ("##" if start else "") + word[start:end]
            if piece in known:
                out.append(known[piece])
                start = end
                break
        else:
            return [vocabulary.UNKNOWN_ID]
    return out if len(word) <= subwords.MAX_WORD_CHARS else [vocabulary.UNKNOWN_ID]


@pytest.mark.parametrize("seed", range(30))
def test_pieces_equal_brute_force(seed):
    import random

    rng = random.Random(seed)
    pieces = random_pieces(rng)
    tries, known = subwords.build_trie(pieces), dict(pieces)
    for _ in range(200):
        word = "".join(rng.choice("abcéx") for _ in range(rng.choice([1, 2, 5, 12, 99, 101])))
        assert [n for n, _ in subwords.cut_word(word, tries)] == longest_first(word, known)


def test_pieces_equal_the_usual_word_piece_model():
    import random

    tokenizers = pytest.importorskip("tokenizers")
    rng = random.Random(8)
    for _ in range(10):
        pieces = random_pieces(rng)
        model = tokenizers.models.WordPiece(
            vocab={**dict(pieces), "[UNK]": 1}, unk_token="[UNK]", max_input_chars_per_word=100
        )
        tries = subwords.build_trie(pieces)
        for _ in range(200):
            word = "".join(rng.choice("abcé") for _ in range(rng.randrange(1, 12)))
            assert [n for n, _ in subwords.cut_word(word, tries)] == [t.id for t in model.tokenize(word)]


def test_encode_pieces(spark):
    pieces = spark.createDataFrame(
        [("walk", 5), ("##ing", 6), ("##s", 7), ("a", 8), ("##b", 9), ("#", 10), ("dog", 11)], "piece string, piece_id int"
    )
    rows = [(1, "Walking dogs", "a"), (2, None, ""), (3, "zzz ab # walks" + "x" * 120, "dog"), (4, "", None)]
    df = spark.createDataFrame(rows, "k long, t string, u string").repartition(3)
    out = {r.k: r for r in subwords.encode_pieces(df, ["t", "u"], pieces).collect()}
    assert (out[1].t_ids, out[1].t_tokens, out[1].t_words) == ([5, 6, 11, 7], ["walk", "##ing", "dog", "##s"], [0, 0, 1, 1])
    assert out[1].u_ids == [8] and out[2].t_ids == [] == out[2].t_words == out[4].t_ids == out[4].u_ids
    assert (out[3].t_ids, out[3].t_words) == ([1, 8, 9, 10, 1], [0, 1, 1, 2, 3])
    assert subwords.encode_pieces(df.limit(0), ["t"], pieces).count() == 0
    long = spark.createDataFrame([("x" * (subwords.MAX_VOCABULARY_CHARS + 1), 5)], "piece string, piece_id int")
    with pytest.raises(ValueError, match="too large"):
        subwords.encode_pieces(df, ["t"], long)


def test_pieces_read_as_words_again(spark):
    from pairmine.functions import spans

    df = spark.createDataFrame([(["[IMG]", "walk", "##ing", "dog", "##s", ",", "#", "#"],)], "t array<string>")
    read = df.select(
        spans.span_text(F.col("t"), F.lit(0), F.lit(7), ["[IMG]"]).alias("all"),
        spans.span_text(F.col("t"), F.lit(2), F.lit(3), ["[IMG]"]).alias("inside"),
    ).first()
    assert (read["all"], read["inside"]) == ("walking dogs, # #", "ing dog")


def test_large_vocabulary_sends_dictionaries_not_occurrences(spark):
    rows = [(str(i), "a b " * 40 + f"w{i}", "c " * i) for i in range(60)] + [("60", None, ""), ("7", "z a", "q"), (None, "a z", None)]
    df = spark.createDataFrame(rows, "k string, x string, y string")
    vocab = vocabulary.build_vocabulary(df, ["x", "y"]).cache()
    known = {r.token: r.token_id for r in vocab.collect()}
    got = vocabulary.encode_tokens(df, "k", ["x", "y"], vocab, vocabulary_rows=10**9)
    assert "collect_list" not in got._jdf.queryExecution().toString()  # an entry per occurrence before
    by_key = {r.k: r for r in got.collect()}
    assert len(by_key) == got.count() == 62
    for k, x, y in rows:
        if k != "7":
            assert by_key[k].x_ids == [known[t] for t in (x or "").split()]
            assert by_key[k].y_ids == [known[t] for t in (y or "").split()]
    held = vocabulary.encode_tokens(df, "k", ["x"], vocab, vocabulary_rows=10**9, keep=["y"]).collect()
    assert sorted((r.k, r.y, len(r.x_tokens)) for r in held if r.k != "7") == sorted(
        (k, y, len((x or "").split())) for k, x, y in rows if k not in ("7", None)
    )
    seven = [r for r in held if r.k == "7"]
    assert len(seven) == 2 and seven[0].x_ids == seven[1].x_ids


def test_pieces_take_little_memory_and_slices_change_nothing(spark, monkeypatch):
    import tracemalloc

    pieces = [(f"{'##' * (i % 2)}{i * 7919:09x}", i) for i in range(50_000)]
    tracemalloc.start()
    tries = subwords.build_trie(pieces)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 150 * len(pieces)  # a dictionary per letter took many times that
    assert [n for n, _ in subwords.cut_word(f"{2 * 7919:09x}{3 * 7919:09x}", tries)] == [2, 3]
    vocab = spark.createDataFrame([("a", 5), ("##b", 6)], "piece string, piece_id int")
    df = spark.createDataFrame([(i, "ab a x " * i) for i in range(30)], "k long, t string").coalesce(1)
    monkeypatch.setattr(subwords, "SLICE_WORDS", 7)
    for r in subwords.encode_pieces(df, ["t"], vocab).collect():
        assert r.t_ids == [5, 6, 5, 1] * r.k and r.t_words == [w for i in range(r.k) for w in (3 * i, 3 * i, 3 * i + 1, 3 * i + 2)]
