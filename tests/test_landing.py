from __future__ import annotations

import json

from tidemark.plans.ingest import ingest_posts, ingest_reviews
from tidemark.sources.landing import normalize_reviews, read_posts_json, read_reviews_csv
from tidemark.sources.tables import read_batches

HEADER = "Id,ProductId,UserId,Extra,Score,Time,Summary,Text\n"


def test_reviews_are_renamed_and_timed(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + "1,P1,U1,x,5,1700000000,good,excellent product\n")
    row = normalize_reviews(read_reviews_csv(spark, str(tmp_path))).first()
    assert (row["review_id"], row["score"], row["review_ts"].year) == (1, 5, 2023)
    assert row["text"] == "excellent product"


def test_bad_values_become_null_and_quoting_is_kept(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + '2,P,U,,many,soon,"a ""q"", b","line one\nline two"\n')
    (tmp_path / "b.csv").write_text(HEADER + "3,P,U,,4,1700000000,s,t\n")
    rows = {r["Id"]: r for r in read_reviews_csv(spark, str(tmp_path)).collect()}
    assert set(rows) == {2, 3}
    assert rows[2]["Score"] is None and rows[2]["Time"] is None
    assert rows[2]["Summary"] == 'a "q", b' and rows[2]["Text"] == "line one\nline two"


def test_posts_from_a_tree_with_mixed_number_types(spark, tmp_path):
    (tmp_path / "x" / "y").mkdir(parents=True)
    post = {"id": "p1", "subreddit": "s", "author": "a", "title": "t", "selftext": "b", "score": 3, "num_comments": "7"}
    post |= {"upvote_ratio": 0.5, "created_utc": 1700000000.0, "ignored": True}
    (tmp_path / "x" / "one.ndjson").write_text(json.dumps(post) + "\n")
    (tmp_path / "x" / "y" / "two.ndjson").write_text(json.dumps(post | {"id": "p2", "score": "bad", "created_utc": 1.7e9}) + "\n")
    (tmp_path / "x" / "other.txt").write_text("not json\n")
    rows = {r["id"]: r for r in read_posts_json(spark, str(tmp_path)).collect()}
    assert set(rows) == {"p1", "p2"}
    assert (rows["p1"]["score"], rows["p1"]["num_comments"], rows["p1"]["created_utc"]) == (3, 7, 1700000000)
    assert rows["p2"]["score"] is None and rows["p2"]["created_utc"] == 1700000000


def test_batches_and_manifests(spark, tmp_path, settings):
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "a.csv").write_text(HEADER + "1,P1,U1,x,5,1700000000,good,fine\n2,P1,U1,x,5,1700000000,good,fine\n")
    manifest = ingest_reviews(spark, settings, str(tmp_path / "csv"), "20240101T000000-aaaaaaaa")
    assert manifest["rows"] == 2 and manifest["source"] == "kaggle_reviews"
    ingest_reviews(spark, settings, str(tmp_path / "csv"), "20240102T000000-bbbbbbbb")
    landed = read_batches(spark, settings.path("landing", "normalized", "reviews"))
    assert landed.count() == 4 and landed.select("_batch_id").distinct().count() == 2
    (tmp_path / "nd").mkdir()
    (tmp_path / "nd" / "a.ndjson").write_text(json.dumps({"id": "p", "created_utc": 1}) + "\n")
    assert ingest_posts(spark, settings, str(tmp_path / "nd"))["rows"] == 1
    stored = [json.loads(r["value"]) for r in spark.read.text(settings.path("_meta", "batches")).collect()]
    assert sorted(m["rows"] for m in stored) == [1, 2, 2]


def test_files_of_one_folder_may_order_their_columns_differently(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Id,ProductId,UserId,Score,Time,Summary,Text\n1,P,U,5,1700000000,"fine, really",body\n')
    (tmp_path / "b.csv").write_text("Time,Score,Text,Summary,Id,Extra\n1700000060,2,other body,poor,2,x\n")
    for multi_line in (True, False):
        rows = {r["Id"]: r for r in read_reviews_csv(spark, str(tmp_path), multi_line).collect()}
        assert (rows[1]["Score"], rows[1]["Summary"], rows[1]["Text"]) == (5, "fine, really", "body")
        assert (rows[2]["Score"], rows[2]["Time"], rows[2]["Summary"], rows[2]["Text"]) == (2, 1700000060, "poor", "other body")
        assert rows[2]["ProductId"] is None


def test_many_files_in_two_layouts_are_one_scan(spark, tmp_path):
    for i in range(40):
        folder = tmp_path / f"drop {i % 3}"
        folder.mkdir(exist_ok=True)
        if i % 2:
            text = f'\ufeffText,Id,Score\n"a, ""{i}""\nb",{i},5\n"",{i + 1000},x\n'
        else:
            text = f"Id,ProductId,UserId,Score,Time,Summary,Text,Extra,Id\n{i},P,U,4,1700000000,s,t,e,77\n{i + 1000},P\n"
        (folder / f"{i}.csv").write_text(text)
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text("Score,Id\n")
    df = read_reviews_csv(spark, str(tmp_path))
    rows = {r["Id"]: r for r in df.collect()}
    assert len(rows) == df.count() == 80
    assert (rows[3]["Text"], rows[3]["Score"], rows[3]["ProductId"]) == ('a, "3"\nb', 5, None)
    assert (rows[4]["ProductId"], rows[4]["Score"], rows[4]["Text"]) == ("P", 4, "t")
    assert rows[1003]["Score"] is None and rows[1004]["ProductId"] == "P" and rows[1004]["Text"] is None
    plan = df.filter("Id > 0")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and "BroadcastHashJoin" in plan


def test_a_folder_without_lines_has_no_reviews(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    df = read_reviews_csv(spark, str(tmp_path))
    assert df.columns[0] == "Id" and df.count() == 0


def test_one_layout_needs_no_join(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.csv").write_text(HEADER + f"{i},P,U,x,5,1700000000,s,t\n")
    df = read_reviews_csv(spark, str(tmp_path))
    assert "Join" not in df._jdf.queryExecution().executedPlan().toString() and df.count() == 3
