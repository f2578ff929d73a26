import pytest

from reviewgate.sources import io


def test_one_bad_date_does_not_end_the_read(spark, tmp_path):
    good = (1, "2024-01-02", "a", "b", "words")
    names = [io.EXPORT_ID, io.EXPORT_DATE, io.EXPORT_ISSUE, io.EXPORT_PRODUCT, io.EXPORT_NARRATIVE]
    rows = [good, (2, "01/03/2024", "a", "b", "more words")]
    lines = [",".join(f'"{n}"' for n in names)] + [",".join(f'"{v}"' for v in r) for r in rows]
    (tmp_path / "x.csv").write_text("\n".join(lines) + "\n")
    got = {r.complaint_id: r.date_received
           for r in io.read_narratives_csv(spark, str(tmp_path / "x.csv")).collect()}
    assert str(got["1"]) == "2024-01-02" and got["2"] is None


def test_a_broken_line_is_an_error(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"complaint_id": "1", "text": "ok"}\n{"complaint_id": "2", \n')
    with pytest.raises(Exception, match="(?i)malformed"):
        io.read_jsonl(spark, str(tmp_path / "x.json")).collect()


def test_manifest_of_nothing_is_one_row_of_zeros(spark):
    from reviewgate.sources.io import split_manifest
    source = spark.createDataFrame([], "complaint_id STRING, date_received DATE, issue STRING, label STRING, text STRING")
    splits = spark.createDataFrame([], "complaint_id STRING, label STRING, text STRING, split STRING")
    rows = split_manifest(source, splits).collect()
    assert len(rows) == 1 and set(rows[0].deduplication) == {0}
    assert rows[0].source_counts == [] and rows[0].splits == []
