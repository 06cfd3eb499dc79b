"""Landing: splits, days, header names, zipped files, the whole pipeline."""

import zipfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from clickloom.operators.clean import clean_events
from clickloom.plans import layers
from clickloom.sources import raw

HEADER = "userid,adgroup_id,time_stamp,pid,click,date,hour,weekday\n"


def write(path, text):
    path.write_text(text)
    return str(path)


@pytest.fixture
def source(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    rows = [f"{u},{10 + u % 2},2017-05-0{5 + u % 3} 1{u}:00:00,p{u % 2},{u % 2},2017-05-0{5 + u % 3},1{u},{4 + u % 3}\n" for u in range(1, 9)]
    write(folder / "train.csv", HEADER + "".join(rows) + rows[0])
    write(folder / "test.csv", HEADER + "3,11,2017-05-08 09:00:00,p1,1,2017-05-08,9,0\n9,99,2017-05-08 10:00:00,p1,0,2017-05-08,10,0\n")
    with zipfile.ZipFile(folder / "ad_feature.csv.zip", "w") as z:
        z.writestr("ad_feature.csv", "adgroup_id,cate_id,campaign_id,customer,brand,price\n10,1,100,7,,9.5\n11,2,101,8,5.0,3.0\n10,1,102,7,6,19.5\n")
    with zipfile.ZipFile(folder / "user_profile.csv.zip", "w") as z:
        lines = "".join(f"{u},0,1,1,2,{'' if u % 2 else u},3,0,{u}.0\n" for u in range(1, 9))
        z.writestr("user_profile.csv", "userid,cms_segid,cms_group_id,final_gender_code,age_level,pvalue_level,shopping_level,occupation,new_user_class_level \n" + lines)
    return str(folder)


def test_events_land_by_day_with_their_source(spark, tmp_path, source, ingested_at):
    raw.write_days(raw.read_events(spark, source, ingested_at), str(tmp_path / "events"))
    days = raw.read_days(spark, str(tmp_path / "events"))
    assert (tmp_path / "events" / "dt=2017-05-05").is_dir()
    assert {r[0] for r in days.select("_source_file").distinct().collect()} == {"train.csv", "test.csv"}
    assert days.select("_ingested_at").distinct().collect()[0][0] == datetime(2024, 1, 1)
    assert days.where("dt = '2017-05-08'").count() == 2
    assert "date" in days.columns and days.where("cast(dt as string) <> date").count() == 0


def test_both_splits_can_share_a_day(spark, tmp_path, ingested_at):
    write(tmp_path / "train.csv", "userid,time_stamp,date\n1,2017-05-05 10:00:00,2017-05-05\n2,2017-05-06 11:00:00,2017-05-06\n")
    write(tmp_path / "test.csv", "userid,time_stamp,date\n3,2017-05-05 12:00:00,2017-05-05\n")
    rows = raw.read_events(spark, str(tmp_path), ingested_at)
    assert sorted(r[0] for r in rows.where("date = '2017-05-05'").select("_split").collect()) == ["test", "train"]


def test_missing_columns_of_a_split_become_null(spark, tmp_path, ingested_at):
    write(tmp_path / "train.csv", "userid,time_stamp,date,pid\n1,2017-05-05 10:00:00,2017-05-05,x\n")
    write(tmp_path / "test.csv", "userid,time_stamp,date\n3,2017-05-05 12:00:00,2017-05-05\n")
    rows = {r.userid: r.pid for r in raw.read_events(spark, str(tmp_path), ingested_at).collect()}
    assert rows == {1: "x", 3: None}


def test_a_rewritten_day_leaves_other_days_alone(spark, tmp_path):
    path = str(tmp_path / "days")
    raw.write_days(spark.createDataFrame([(1, "2017-05-05"), (2, "2017-05-06")], "a int, date string"), path)
    raw.write_days(spark.createDataFrame([(3, "2017-05-06")], "a int, date string"), path)
    assert sorted(r.a for r in raw.read_days(spark, path).collect()) == [1, 3]


@pytest.mark.parametrize("zipped", [False, True])
def test_header_names_are_trimmed(spark, tmp_path, ingested_at, zipped):
    text = "userid, new_user_class_level \n1,1.0\n2,\n"
    path = tmp_path / ("user_profile.csv.zip" if zipped else "user_profile.csv")
    if zipped:
        with zipfile.ZipFile(path, "w") as z:
            z.writestr("user_profile.csv", text)
    else:
        path.write_text(text)
    out = raw.read_dimension(spark, str(path), raw.USER_SCHEMA, ingested_at)
    assert all(c == c.strip() for c in out.columns)
    assert [r.new_user_class_level for r in out.orderBy("userid").collect()] == [1.0, None]
    assert {r[0] for r in out.select("_source_file").collect()} == {path.name}


def test_zip_rows_come_in_batches_and_in_order(spark, tmp_path):
    path = tmp_path / "ad_feature.csv.zip"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("a.csv", "adgroup_id,price\n" + "".join(f"{i},{i}.5\n" for i in range(1000)))
    rows = raw.read_zipped_csv(spark, str(path), raw.AD_SCHEMA, rows_per_batch=64).orderBy("_row").collect()
    assert [r.adgroup_id for r in rows] == list(range(1000)) and [r._row for r in rows] == list(range(1000))


def test_members_of_an_archive_are_read_apart(spark, tmp_path):
    path = tmp_path / "ad_feature.csv.zip"
    with zipfile.ZipFile(path, "w") as z:
        for m in range(8):
            z.writestr(f"part{m}.csv", "adgroup_id,price\n" + "".join(f"{100 * m + i},1.5\n" for i in range(100)))
        z.writestr("notes.txt", "no table")
    df = raw.read_zipped_csv(spark, str(path), raw.AD_SCHEMA)
    tasks = df.withColumn("task", F.spark_partition_id()).groupBy("task").agg(F.countDistinct("_block").alias("n")).collect()
    assert [r.n for r in tasks] == [1] * 8
    got = [(r.adgroup_id, r._block, r._row) for r in df.orderBy("_block", "_row").collect()]
    assert got == [(100 * m + i, m, i) for m in range(8) for i in range(100)]


def zipped(path, text, name="ad_feature.csv"):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr(name, text)
    return str(path)


@pytest.mark.parametrize("in_memory", [1 << 30, 0])
def test_zip_keeps_large_ids_and_unknown_columns(spark, tmp_path, monkeypatch, in_memory):
    monkeypatch.setattr(raw, "IN_MEMORY", in_memory)
    path = zipped(tmp_path / "ad_feature.csv.zip", "adgroup_id, color ,cate_id,brand\n9007199254740993,red,3.0,1.5\n2,,,\n")
    rows = {r.adgroup_id: r for r in raw.read_zipped_csv(spark, path, raw.AD_SCHEMA).collect()}
    assert rows[9007199254740993].color == "red" and rows[9007199254740993].cate_id == 3 and rows[9007199254740993].brand == 1.5
    assert rows[2].color is None and rows[2].cate_id is None and rows[2].price is None


@pytest.mark.parametrize("bad", ["7.9", "x"])
def test_zip_ids_must_be_whole(spark, tmp_path, bad):
    path = zipped(tmp_path / "ad_feature.csv.zip", f"adgroup_id,price\n{bad},1\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        raw.read_zipped_csv(spark, path, raw.AD_SCHEMA).collect()


def test_of_a_train_and_a_test_copy_the_train_row_stays(spark, tmp_path, ingested_at):
    for name, click in (("train", 1), ("test", 0)):
        write(tmp_path / f"{name}.csv", HEADER + f"3,11,2017-05-08 09:00:00,p1,{click},2017-05-08,9,0\n")
    rows = clean_events(raw.read_events(spark, str(tmp_path), ingested_at)).collect()
    assert [(r._split, r.click) for r in rows] == [("train", 1)]


def test_layers_leave_settings_and_no_scratch_tables(spark, tmp_path, source, ingested_at):
    import os
    from clickloom.session import shared_folder
    before = spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "true")
    try:
        here = set(os.listdir(shared_folder(spark)))
        layers.run(spark, source, str(tmp_path / "lake"), ingested_at=ingested_at)
        assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
        assert set(os.listdir(shared_folder(spark))) == here
    finally:
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", before)


def test_training_writes_everything(spark, tmp_path):
    from clickloom.plans.lake import Lake
    lake = str(tmp_path / "lake")
    Lake.at(spark, "/root/testdata/sf0.001").gold.write.parquet(f"{lake}/gold/training_features.parquet")
    sizes = {"logistic": {"max_iter": 10}, "forest": {"numTrees": 3, "maxDepth": 3}}
    took = layers.run(spark, "", lake, "train", training={"settings": sizes, "names": list(sizes), "repeats": 1})
    assert list(took) == ["train"]
    table = spark.read.parquet(f"{lake}/train/comparison.parquet").collect()
    assert {r.model for r in table} == {"logistic", "forest", "popularity", "random"}
    assert spark.read.parquet(f"{lake}/train/lift.parquet").count() == 6
    assert spark.read.parquet(f"{lake}/train/permutation_importance.parquet").count() == 40
    recs = spark.read.json(f"{lake}/train/recommendations.json")
    gold = spark.read.parquet(f"{lake}/gold/training_features.parquet")
    asked = gold.where("_split = 'train'").join(gold.where("_split = 'test'").select("userid_key").distinct(), "userid_key", "left_semi")
    assert recs.count() == asked.select("userid_key").distinct().count() and all(len(r.recommendations) <= 100 for r in recs.collect())


def test_pipeline_end_to_end(spark, tmp_path, source, ingested_at):
    lake = str(tmp_path / "lake")
    took = layers.run(spark, source, lake, ingested_at=ingested_at)
    assert list(took) == ["bronze", "silver", "gold"]
    fact = spark.read.parquet(f"{lake}/silver/fact_events")
    assert fact.count() == 10  # the repeated train row is gone
    assert set(fact.columns) == {"userid", "adgroup_id", "time_stamp", "click", "pid", "hour", "weekday", "date", "_split", "dt"}
    ads = {r.adgroup_id: r for r in spark.read.parquet(f"{lake}/silver/dim_ad.parquet").collect()}
    assert ads[10].campaign_id == 102 and ads[10].brand == "6" and ads[11].brand == "5"
    users = {r.userid: r for r in spark.read.parquet(f"{lake}/silver/dim_user.parquet").collect()}
    assert users[1].pvalue_level == "unknown" and users[2].pvalue_level == "2" and users[1].cms_segid == 0
    gold = spark.read.parquet(f"{lake}/gold/training_features.parquet")
    assert gold.count() == 10
    lost = gold.where("userid_key = 9").collect()[0]  # neither its ad nor its user is in a dimension
    assert lost.cate_id == "-1" and lost.price is None and lost.cate_impressions_before == 0
    snapshot = spark.read.parquet(f"{lake}/gold/item_coclick_snapshot.parquet")
    assert snapshot.columns == ["prev_item", "item", "cnt", "total"]


def test_single_layer_and_unknown_layer(spark, tmp_path, source):
    assert list(layers.run(spark, source, str(tmp_path / "lake"), "bronze")) == ["bronze"]
    with pytest.raises(ValueError, match="platinum"):
        layers.run(spark, source, str(tmp_path / "lake"), "platinum")


def test_gold_without_train_rows_has_an_empty_snapshot(spark):
    from clickloom.operators.coclick import coclick_snapshot
    rows = spark.createDataFrame([("test", 1, 5, 6)], "_split string, click int, user_prev_clicked_item long, adgroup_id long")
    assert coclick_snapshot(rows).count() == 0
