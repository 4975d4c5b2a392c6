"""Korean text rules, which the driver tables cannot exercise."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from reviewmill.functions import scoring
from reviewmill.functions import text as tx
from reviewmill.operators import filters, profile
from reviewmill.operators import tokens as tk


def one(spark, column, value=None):
    frame = spark.createDataFrame([(value,)], "t string")
    return frame.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "text, want",
    [("맛있어요😀☕", "맛있어요"), ("😀☕", ""), ("", ""), (None, None), ("a✂b🚀", "ab")],
)
def test_remove_emojis(spark, text, want):
    assert one(spark, tx.remove_emojis("t"), text) == want


@pytest.mark.parametrize("text, want", [("좋아요☀", True), ("좋아요", False), (None, False)])
def test_has_emoji(spark, text, want):
    assert one(spark, tx.has_emoji("t"), text) is want


def test_special_and_digits(spark):
    assert one(spark, tx.remove_special("t"), "맛있어요! 100점_a") == "맛있어요 100점_a"
    assert one(spark, tx.remove_digits("t"), "맛있어요 100점_a") == "맛있어요 점_a"


def test_hangul_only(spark):
    assert one(spark, tx.hangul_only("t"), " ok 맛있다ㅋㅋ!! 10점　") == "맛있다ㅋㅋ 점"


def test_tag_chain(spark):
    tags = "매장이 청결해요 특별한 메뉴가 있어요"
    assert one(spark, tx.normalize_tags("t"), tags) == "청결 특별한 메뉴"
    assert one(spark, tx.normalize_tags("t"), None) == ""


@pytest.mark.parametrize("text", ["", "a", "a  b", " a b ", "a\tb　c\xa0d", "x\x1cy"])
def test_splits_as_python_does(spark, text):
    assert one(spark, tx.split_space("t"), text) == text.split(" ")
    assert one(spark, tx.split_whitespace("t"), text) == text.split()
    assert one(spark, tx.strip("t"), text) == text.strip()


def test_delimiters_and_pipe(spark):
    assert one(spark, tx.split_delimiters("t"), ' a,b("c")*d ') == ["a", "b", "c", "d"]
    assert one(spark, tx.split_pipe("t"), "a||b") == ["a", "", "b"]


def test_predicate_form(spark):
    assert one(spark, tx.predicate_form("t"), "좋") == "좋다"
    assert one(spark, tx.predicate_form("t"), "좋다") == "좋다"


def test_punctuation_links_mentions(spark):
    assert one(spark, tx.unify_punctuation("t"), "가·나 ‘다’ 「라」～") == "가/나 '다' <라>~"
    assert one(spark, tx.remove_links("t"), "보세요 http://a.b/c 끝") == "보세요  끝"
    assert one(spark, tx.remove_mentions("t"), "@친구 안녕") == " 안녕"


def test_crawl_fields(spark):
    assert one(spark, tx.last_line("t"), "별점\n4.5") == "4.5"
    assert one(spark, tx.without("t", "번째 방문"), "2번째 방문") == "2"
    assert one(spark, tx.empty_to("t", "x"), "") == "x"


def test_half_even_rounding(spark):
    assert one(spark, scoring.percentage(F.lit(1), F.lit(32), 2)) == 3.12
    for part, whole in [(1, 3), (7, 64), (2, 3), (3, 32), (0, 5)]:
        got = one(spark, scoring.percentage(F.lit(part), F.lit(whole), 2))
        assert got == round(part / whole * 100, 2)
    assert one(spark, scoring.percentage(F.lit(1), F.lit(0), 2)) is None


@pytest.mark.parametrize(
    "counts, want",
    [
        ((0, 0, 0), "Positive"),
        ((1, 1, 0), "Positive"),
        ((0, 1, 1), "Negative"),
        ((0, 0, 1), "Neutral"),
        ((1, 2, 3), "Neutral"),
        ((1, 0, 1), "Positive"),
    ],
)
def test_dominant_class(spark, counts, want):
    p, n, u = map(F.lit, counts)
    assert one(spark, scoring.dominant_class(p, n, u)) == want
    neutral = one(spark, scoring.dominant_class(p, n, u, "neutral"))
    assert neutral == ("Neutral" if counts == (0, 0, 0) else want)


def test_sign_class(spark):
    assert one(spark, scoring.sign_class_ko(F.lit(-0.5))) == "부정"
    assert one(spark, scoring.sign_class(F.lit(0))) == "Neutral"
    assert one(spark, scoring.fixed2(F.lit(2.5))) == "2.50"


def test_keyword_match_with_regex_characters(spark):
    frame = spark.createDataFrame([("a+b",), ("aab",), (None,)], "t string")
    literal = frame.filter(filters.keyword_match("t", "a+b", regex=False)).collect()
    regex = frame.filter(filters.keyword_match("t", "a+b")).collect()
    assert [r.t for r in literal] == ["a+b"]
    assert [r.t for r in regex] == ["aab"]


def test_header_guard(spark):
    frame = spark.createDataFrame(
        [("대학교 이름",), ("﻿대학교 이름",), ("명지대",), (None,)], "university_name string"
    )
    kept = {r.university_name for r in filters.without_header(frame).collect()}
    assert kept == {"명지대", None}


def test_tagging(spark):
    reviews = spark.createDataFrame(
        [(1, "커피가 정말 맛있어요! 10점"), (2, None), (3, "")], "id long, t string"
    )
    dictionary = spark.createDataFrame(
        [("커피가", "커피", "Noun"), ("정말", "정말", "Adverb"), ("맛있어요", "맛있다", "Adjective")],
        "surface string, lemma string, pos string",
    )
    got = {r.id: r.processed_review for r in tk.content_text(reviews, "t", "id", dictionary).collect()}
    assert got == {1: "커피 정말 맛있다", 2: "", 3: ""}
    tags = [
        (r.surface, r.pos)
        for r in tk.tag_tokens(reviews, "t", ["id"], dictionary).orderBy("token_no").collect()
    ]
    assert tags == [
        ("커피가", "Noun"),
        ("정말", "Adverb"),
        ("맛있어요", "Adjective"),
        ("!", "Punctuation"),
        ("10", "Number"),
        ("점", "Unknown"),
    ]
    words = tk.lemmatize(reviews.filter("id = 1"), "t", "id", dictionary).first().words
    assert words == "커피 맛있다"


def test_keyword_contexts(spark):
    text = "a b c dX e f g"
    frame = spark.createDataFrame([(1, text), (2, "X"), (3, None)], "id long, t string")
    got = sorted(tuple(r) for r in tk.keyword_contexts(frame, "t", ["id"], "X").collect())
    assert got == [(1, 3, "a b c dX e f"), (2, 0, "X")]


def test_histogram_counts_everything(spark):
    frame = spark.createDataFrame([(float(x),) for x in range(41)], "v double")
    bins = profile.histogram(frame, "v", 20).orderBy("bin").collect()
    assert len(bins) == 20
    assert sum(r.n for r in bins) == 41
    assert bins[-1].n == 3
    flat = spark.createDataFrame([(1.0,), (1.0,)], "v double")
    assert sum(r.n for r in profile.histogram(flat, "v", 20).collect()) == 2


def _odd_reviews(spark):
    rows = [(1, "a", "the cats are big the"), (1, "a", "dogs 12 !! the"), (2, "a", None), (3, "b", ""), (None, "b", "are cats"), (4, None, "12")]
    return spark.createDataFrame([(*r, 1) for r in rows], "review_id long, university_name string, review_text string, extra int")


def _listed_and_rows(spark, monkeypatch, job):
    """Results by lists and by token rows, and the plan by lists."""
    from reviewmill.operators import merging  # noqa: F401
    from reviewmill.plans import jobs

    found = job(_odd_reviews(spark))
    plan = found._jdf.queryExecution().executedPlan().toString()
    listed = sorted(map(str, found.collect()))
    monkeypatch.setattr(tk, "list_lookup", lambda *a: None)
    monkeypatch.setattr(jobs, "list_lookup", lambda *a: None)
    return listed, sorted(map(str, job(_odd_reviews(spark)).collect())), plan


def _words(spark, repeated=False):
    rows = [("cats", "cat", "Noun"), ("are", "be", "Verb"), ("big", "big", "Adjective"), ("the", "the", "Josa")]
    return spark.createDataFrame(rows + rows[:1] * repeated, "surface string, lemma string, pos string")


@pytest.mark.parametrize("name", ["content", "columns", "lemmas", "morphemes", "scores", "nouns"])
def test_lists_equal_token_rows(spark, monkeypatch, name):
    from reviewmill.plans import jobs

    words = _words(spark)
    lexicon = spark.createDataFrame([("cat", 2), ("be다", -1), ("dogs", 1), (None, 5)], "word string, polarity int")
    stop = spark.createDataFrame([("dogs",), (None,)], "word string")
    job = {
        "content": lambda d: tk.content_text(d, "review_text", "review_id", words, keep=["extra"]),
        "columns": lambda d: tk.pos_columns(d, "review_text", "review_id", words, {"n": ["Noun"], "a": ["Adjective"]}, "Noun"),
        "lemmas": lambda d: tk.lemmatize(d, "review_text", "review_id", words, "Noun"),
        "morphemes": lambda d: tk.regroup(
            tk.tag_tokens(d, "review_text", ["review_id"], words, normalize=lambda c: c, listed=True),
            ["review_id"],
            {"m": lambda t: t["lemma"]},
        ),
        "scores": lambda d: jobs.review_scores(
            d.drop("university_name"), lexicon, words, clean=lambda c: d[c], with_text=False, default_pos="Noun"
        ),
        "nouns": lambda d: jobs.noun_lists(d, words, stop, default_pos="Noun", slice_rows=2, part_chars=5),
    }[name]
    listed, rows, plan = _listed_and_rows(spark, monkeypatch, job)
    assert listed == rows and listed
    if name != "nouns":
        assert "posexplode" not in plan  # tokens are no rows, so none are shuffled


def test_repeated_surfaces_go_by_rows(spark):
    tagged = tk.tag_tokens(_odd_reviews(spark), "review_text", ["review_id"], _words(spark, True), listed=True)
    assert not tk.is_listed(tagged)
