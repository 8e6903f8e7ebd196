"""The reference's CSV layout (S1, S2, U1, U2, D1) and the sinks."""

import pytest
from pyspark.errors import AnalysisException

from profila.operators.events import device_event_aggregates
from profila.sources import read_artefact, read_device_csv, read_event_csv, write_artefact, write_result
from profila.session import durable, remove_tables, tables_folder
from profila.sources.files import read_test_ids


def _write(path, text):
    path.write_text(text)


def test_csv_layout_round_trip(spark, tmp_path):
    _write(tmp_path / "train.csv", "device_id,gender,age,phone_brand,device_model\n"
                                  "1,0,30,5,50\n1,0,30,5,50\n2,1,41,6,60\n")
    _write(tmp_path / "test.csv", "device_id,phone_brand,device_model\n3,5,51\n3,5,51\n4,7,70\n")
    _write(tmp_path / "train_app_events.csv", "event_id,device_id,app_id,is_installed,is_active,tag_list,date\n"
                                             '1,1,42,1,1,"t1,t2",1\n2,2,42,1,0,t3,2\n')
    _write(tmp_path / "test_app_events.csv", "event_id,device_id,app_id,is_installed,is_active,tag_list,date\n"
                                            '3,3,7,0,1,"t1,t2,t3",9\n')
    devs = read_device_csv(spark, str(tmp_path))
    assert devs.count() == 4                                  # whole-row duplicates dropped (D1)
    assert devs.where("is_train = 0 and gender is null").count() == 2  # labels missing on test rows (U2)
    ev = read_event_csv(spark, str(tmp_path))
    assert ev.count() == 3                                    # both event files (U1)
    aggs = {r.device_id: r for r in device_event_aggregates(ev).collect()}
    assert aggs[3].tag_list_len_mean == 3.0 and aggs[1].is_active_sum == 1
    raw = read_test_ids(spark, str(tmp_path))
    assert raw.count() == 3                                   # S2 keeps duplicates


def test_csv_columns_go_by_name(spark, tmp_path):
    _write(tmp_path / "train.csv", "note,device_id,phone_brand,device_model,gender,age\nx,1,5,50,0,30\ny,2,6,60,,old\n")
    _write(tmp_path / "test.csv", "device_model,device_id,phone_brand\n51,3,5\n")
    _write(tmp_path / "train_app_events.csv", "date,event_id,device_id,app_id,is_installed,is_active,tag_list\n9,1,1,42,1,0,t1\n")
    _write(tmp_path / "test_app_events.csv", "event_id,device_id,app_id,is_installed,is_active,tag_list,date,more\n3,3,7,0,1,t2,8,z\n")
    rows = {r.device_id: r for r in read_device_csv(spark, str(tmp_path)).collect()}
    assert (rows[1].phone_brand, rows[1].device_model, rows[1].gender, rows[1].age) == (5, 50, 0, 30)
    assert (rows[2].gender, rows[2].age) == (None, None)  # missing, and not a number
    assert (rows[3].phone_brand, rows[3].device_model, rows[3].gender) == (5, 51, None)
    events = {r.event_id: (r.device_id, r.app_id, r.is_active, r.date, r.tag_list) for r in read_event_csv(spark, str(tmp_path)).collect()}
    assert events == {1: (1, 42, 0, 9, "t1"), 3: (3, 7, 1, 8, "t2")}
    _write(tmp_path / "test.csv", "device_id,brand\n3,5\n")
    with pytest.raises(AnalysisException):
        read_test_ids(spark, str(tmp_path))


def test_written_tables_are_removed(spark):
    other = spark.newSession()
    durable(spark.range(3))
    fs = spark._jvm.org.apache.hadoop.fs.Path(tables_folder(spark))
    there = fs.getFileSystem(spark._jsc.hadoopConfiguration())
    assert there.exists(fs)
    remove_tables(other)
    assert not there.exists(fs)


def test_artefact_and_result_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.25, 0.75), (2, 0.5, 0.5)], "device_id long, x_clf_0 double, x_clf_1 double")
    write_artefact(df, str(tmp_path / "stage"))
    back = read_artefact(spark, str(tmp_path / "stage"))
    assert sorted(back.collect()) == sorted(df.collect())
    res = spark.createDataFrame([(1, 0, 31.5)], "device_id long, gender int, age double")
    write_result(res, str(tmp_path / "result"))
    text = spark.read.option("header", True).csv(str(tmp_path / "result"))
    assert text.columns == ["device_id", "gender", "age"] and text.first().age == "31.5"
