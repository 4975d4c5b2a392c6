"""Readers and writers on small hand-made files."""

from __future__ import annotations

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from reviewmill.functions.constants import REVIEW_COLUMNS, REVIEW_COLUMNS_KO
from reviewmill.operators import filters, profile
from reviewmill.operators.skew import shared_folder
from reviewmill.plans import jobs
from reviewmill.sources import crawl, readers, writers


def test_quoted_reviews_with_bom(spark, tmp_path):
    path = tmp_path / "r.csv"
    body = (
        '명지대,설빙,4.5,10,"맛있어요, 정말\n또 올게요 ""최고""",2023.12.20.,2,"친절해요"\n'
        "명지대,빈집,평점 없음,3,,2023.1.1.,방문 정보 없음,\n"
    )
    path.write_text("﻿" + ",".join(REVIEW_COLUMNS_KO) + "\n" + body, encoding="utf-8")
    rows = readers.read_reviews(spark, str(path)).orderBy("review_id").collect()
    assert len(rows) == 2
    assert rows[0].review_text == '맛있어요, 정말\n또 올게요 "최고"'
    assert (rows[0].shop_avg_rating, rows[0].shop_visit_count) == (4.5, 2)
    assert (rows[1].shop_avg_rating, rows[1].shop_visit_count, rows[1].review_text) == (None, None, None)


def test_names(spark):
    korean = spark.createDataFrame([("a",) * 8], [f" {c} " for c in REVIEW_COLUMNS_KO])
    assert readers.english_names(korean).columns == REVIEW_COLUMNS
    assert readers.positional_names(korean).columns == REVIEW_COLUMNS
    other = spark.createDataFrame([("a", "b")], ["university", "review"])
    assert readers.english_names(other).columns == ["university_name", "review_text"]


def test_lexicons(spark, tmp_path):
    good = tmp_path / "good.txt"
    good.write_text("﻿좋다\t2\n나쁘다\t-1\n좋다\t1\n", encoding="utf-8")
    got = {r.word: r.polarity for r in readers.read_lexicon(spark, str(good)).collect()}
    assert got == {"좋다": 1, "나쁘다": -1}
    bad = tmp_path / "bad.txt"
    bad.write_text("좋다\t2\n깨진줄\n나쁘다\tx\n셋\t1\t2\n", encoding="utf-8")
    entries, rejects = readers.read_lexicon_lenient(spark, str(bad))
    assert [tuple(r) for r in entries.collect()] == [("좋다", 2)]
    assert {r.value for r in rejects.collect()} == {"깨진줄", "나쁘다\tx", "셋\t1\t2"}
    with pytest.raises(Exception, match="malformed lexicon line"):
        readers.read_lexicon(spark, str(bad)).collect()


def test_stop_words(spark, tmp_path):
    path = tmp_path / "stop.txt"
    path.write_text("이\n그\n\n이\n", encoding="utf-8")
    words = readers.join_word_lists(readers.read_words(spark, str(path)), readers.word_list(spark, ["그", "저"]))
    assert {r.word for r in words.collect()} == {"이", "그", "저"}


def test_result_parts_skip_missing_folders(spark, tmp_path):
    folder = str(tmp_path / "out")
    rows = spark.createDataFrame([(" u ", "c", 4.5, 3, 9)], readers.RANKING_SCHEMA)
    writers.store_delimited(rows, folder)
    back = readers.read_result_parts(spark, [folder, folder + "x"]).collect()
    assert [tuple(r) for r in back] == [("u", "c", 4.5, 3, 9)]
    assert readers.read_result_parts(spark, [folder + "x"]).isEmpty()
    with pytest.raises(AnalysisException):
        writers.store_delimited(rows, folder)


def test_unquoted_delimited_and_bad_numbers(spark, tmp_path):
    path = tmp_path / "core.csv"
    path.write_text('u,"c",4.72,3,x\n', encoding="utf-8")
    row = readers.read_core(spark, str(path)).first()
    assert row.cafeName == '"c"' and row.reviewerCount == 3 and row.visitCount is None


def test_materialize_replaces_interrupted_output(spark, tmp_path):
    path = tmp_path / "m"
    (path / "_temporary").mkdir(parents=True)
    first = writers.materialize(spark.range(3), str(path))
    assert first.count() == 3
    assert writers.materialize(spark.range(9), str(path)).count() == 3


def test_single_file(spark, tmp_path):
    path = tmp_path / "one"
    writers.write_csv(spark.range(100).repartition(4), str(path), single_file=True)
    assert len([p for p in path.iterdir() if p.name.startswith("part")]) == 1
    assert spark.read.option("header", True).csv(str(path)).count() == 100


def test_safe_name():
    assert writers.safe_name("명지대 인문/캠퍼스", "딸기") == "명지대_인문_캠퍼스_딸기"


def test_crawl_files(spark, tmp_path):
    shops = [
        {
            "가게이름": "설빙",
            "가게 평균 평점": "별점\n4.5",
            "가게 리뷰": [
                {"리뷰어 리뷰수": "10", "리뷰 텍스트": "좋아요", "리뷰 날짜": "2023.12.20.",
                 "가게 방문수": "2번째 방문", "태그들": ["맛있어요", "친절해요"]},
                {"리뷰어 리뷰수": "리뷰 7", "리뷰 텍스트": "음", "리뷰 날짜": "2023.1.1.",
                 "가게 방문수": "방문 정보 없음", "태그들": []},
            ],
        },
        {"가게이름": "빈집", "가게 평균 평점": "평점 없음", "가게 리뷰": []},
    ]
    path = tmp_path / "mju_reviews_20231220_101010.json"
    path.write_text(json.dumps(shops, ensure_ascii=False, indent=2), encoding="utf-8")
    nested = crawl.read_crawl(spark, str(path))
    rows = {r.review_text: r for r in crawl.flatten_crawl(nested, ["university_name"]).collect()}
    assert rows["좋아요"].university_name == "mju"
    assert (rows["좋아요"].shop_avg_rating, rows["좋아요"].shop_visit_count) == (4.5, 2)
    assert rows["좋아요"].tags == "맛있어요 친절해요"
    assert (rows["음"].reviewer_review_count, rows["음"].shop_visit_count) == (7, None)
    assert rows[None].shop_name == "빈집" and rows[None].shop_avg_rating is None


def test_records(spark):
    lines = spark.createDataFrame([("u,s,text,k",), ("a,b",), ("k\tPositive\tw",), ("k\tw",)], "value string")
    comma = readers.comma_records(lines, 3, {1: "shop", 2: "review"}).collect()
    assert [tuple(r) for r in comma] == [("s", "text")]
    tab = readers.tab_records(lines, ["shop", "sentiment", "word"]).collect()
    assert [tuple(r) for r in tab] == [("k", "Positive", "w")]


def test_clean_and_profile(spark):
    raw = spark.createDataFrame(
        [(1, "😀", None), (2, None, "t"), (3, "", "t"), (4, "좋아요☕", "t")],
        "id long, review_text string, tags string",
    )
    cleaned = {r.id: (r.review_text, r.tags) for r in jobs.clean_reviews(raw).collect()}
    assert cleaned == {
        1: ("리뷰 없음", "태그 없음"),
        2: ("리뷰 없음", "t"),
        3: ("리뷰 없음", "t"),
        4: ("좋아요", "t"),
    }
    counts = {r.column_name: (r.null_count, r.empty_count) for r in profile.null_profile(raw).collect()}
    assert counts == {"id": (0, 0), "review_text": (1, 1), "tags": (1, 0)}


def test_preprocess(spark):
    reviews = spark.createDataFrame(
        [(1, "u", "s", "딸기 맛있어요"), (2, "u", "s", "커피"), (3, "v", "s", "딸기")],
        "review_id long, university_name string, shop_name string, review_text string",
    )
    dictionary = spark.createDataFrame(
        [("딸기", "딸기", "Noun"), ("맛있어요", "맛있다", "Adjective")],
        "surface string, lemma string, pos string",
    )
    rows = jobs.preprocess_reviews(reviews, "u", "딸기", dictionary).collect()
    assert [(r.review_id, r.processed_review, r.keyword) for r in rows] == [(1, "딸기 맛있다", "딸기")]
    with pytest.raises(ValueError, match="nothing"):
        filters.require_rows(reviews.filter(F.col("university_name") == "x"), "nothing")


def test_shared_folder_follows_the_session(spark):
    assert shared_folder(spark).startswith("/tmp/")

    class Cluster:
        class conf:  # noqa: N801
            @staticmethod
            def get(key, default):
                return "/shared/place" if key == "spark.checkpoint.dir" else default

    assert shared_folder(Cluster) == "/shared/place"


@pytest.mark.parametrize("multiline", [False, True])
def test_ids_do_not_depend_on_splits(spark, tmp_path, multiline):
    want, count = [], 0
    for name, rows in (("b.csv", 300), ("a.csv", 700), ("c.csv", 0), ("d.csv", 1)):
        texts = [f"{name} {i} " + "x" * (i % 40) for i in range(rows)]
        lines = [",".join(REVIEW_COLUMNS_KO), *[f"u,s,4.5,{i},{t},d,2,x" for i, t in enumerate(texts)]]
        (tmp_path / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
    for name, rows in (("a.csv", 700), ("b.csv", 300), ("d.csv", 1)):
        want += [(count + i, f"{name} {i} " + "x" * (i % 40)) for i in range(rows)]
        count += rows
    settings = {"spark.sql.files.maxPartitionBytes": ("900", "20000", "128m"), "spark.sql.files.openCostInBytes": ("0", "4000", "4m")}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for i in range(3):
            for k, values in settings.items():
                spark.conf.set(k, values[i])
            read = readers.read_reviews(spark, str(tmp_path), multiline=multiline)
            if i == 0 and not multiline:
                assert read.rdd.getNumPartitions() > 20
            got = read.select("review_id", "review_text").collect()
            assert sorted(tuple(r) for r in got) == want
            few = read.filter("reviewer_review_count = 250").select("review_id").collect()
            assert sorted(r[0] for r in few) == [250, 950]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_required_rows(spark):
    from reviewmill.catalog import inputs as inp

    reviews = spark.createDataFrame(
        [(1, "u", "s", "딸기")], "review_id long, university_name string, shop_name string, review_text string"
    )
    dictionary = inp.dictionary(spark)
    with pytest.raises(ValueError, match="no reviews of v$"):
        jobs.preprocess_reviews(reviews, "v", "딸기", dictionary, required=True)
    with pytest.raises(ValueError, match="no reviews of u with 포도"):
        jobs.preprocess_reviews(reviews, "u", "포도", dictionary, default_pos="Noun", required=True)
    assert jobs.preprocess_reviews(reviews, "v", "딸기", dictionary).collect() == []
    assert jobs.preprocess_reviews(reviews, "u", "딸기", dictionary, default_pos="Noun", required=True).count() == 1


def test_local_tables_need_no_python_workers(spark):
    from reviewmill.session import local_table

    key = "spark.sql.execution.arrow.pyspark.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        found = local_table(spark, [("a", 1), ("b", None)], "word string, polarity int")
        assert "LocalRelation" in found._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(map(tuple, found.collect())) == [("a", 1), ("b", None)]
        assert local_table(spark, [], "word string").count() == 0
    finally:
        spark.conf.set(key, before)
