import pytest
from frames import by_id
from pyspark.sql import functions as F

from reviewrank.operators.validate import check_claims
from reviewrank.sources import cms
from reviewrank.sources.tables import read_claims, read_text_csv


def frame(spark, **columns):
    names = list(columns)
    rows = list(zip(*columns.values()))
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))


def test_inpatient(spark):
    source = frame(
        spark,
        DESYNPUF_ID=["BENE01"],
        CLM_ID=["1001"],
        CLM_FROM_DT=["20090102"],
        PRVDR_NUM=["HOSP01"],
        CLM_PMT_AMT=["1250.50"],
        CLM_UTLZTN_DAY_CNT=["3"],
        ADMTNG_ICD9_DGNS_CD=["25000"],
        ICD9_DGNS_CD_1=["4019"],
        ICD9_PRCDR_CD_1=["9904"],
        HCPCS_CD_1=["99223"],
    )
    row = cms.adapt_cms(source, "inpatient").first()
    assert row["claim_id"] == "CMS-INPATIENT-1001"
    assert row["source_claim_id"] == "1001"
    assert row["beneficiary_id"] == "CMS-BEN-BENE01"
    assert row["provider_id"] == "CMS-PRV-HOSP01"
    assert (row["paid_amount"], row["diagnosis_count"], row["procedure_count"]) == (1250.50, 2, 2)
    assert (row["units"], row["length_of_stay"]) == (2, 3)
    assert str(row["service_date"]) == "2009-01-02 00:00:00"


def test_stay_from_dates(spark):
    source = frame(
        spark,
        DESYNPUF_ID=["B", "B", "B"],
        CLM_ID=["1", "2", "3"],
        CLM_FROM_DT=["20090102"] * 3,
        CLM_PMT_AMT=["1", "-5", "x"],
        CLM_ADMSN_DT=["20090102", "20090105", None],
        CLM_THRU_DT=["20090104", "20090101", "20090101"],
    )
    table = cms.adapt_cms(source, "inpatient")
    assert by_id(table, "length_of_stay") == {f"CMS-INPATIENT-{i}": d for i, d in ((1, 3), (2, 0), (3, 0))}
    assert by_id(table, "paid_amount") == {f"CMS-INPATIENT-{i}": d for i, d in ((1, 1.0), (2, 0.0), (3, 0.0))}
    assert by_id(table, "provider_id")["CMS-INPATIENT-1"] == "CMS-NO-PROVIDER-CMS-INPATIENT-1"


def test_carrier_lines(spark):
    source = frame(
        spark,
        DESYNPUF_ID=["BENE02"],
        CLM_ID=["2002"],
        CLM_FROM_DT=["20081215"],
        PRF_PHYSN_NPI_2=["9"],
        PRF_PHYSN_NPI_1=["1234567890"],
        HCPCS_CD_1=["99213"],
        HCPCS_CD_2=["80053"],
        ICD9_DGNS_CD_1=["2724"],
        LINE_NCH_PMT_AMT_1=["75.25"],
        LINE_NCH_PMT_AMT_2=["24.75"],
    )
    row = cms.adapt_cms(source, "carrier").first()
    assert (row["paid_amount"], row["provider_id"]) == (100.0, "CMS-PRV-1234567890")
    assert (row["procedure_count"], row["units"]) == (2, 2)
    tax = source.withColumns({"PRF_PHYSN_NPI_1": F.lit("nan"), "PRF_PHYSN_NPI_2": F.lit(" "), "TAX_NUM_1": F.lit("77")})
    assert cms.adapt_cms(tax, "carrier").first()["provider_id"] == "CMS-PRV-77"
    with pytest.raises(ValueError, match="LINE_NCH_PMT_AMT"):
        cms.adapt_cms(source.drop("LINE_NCH_PMT_AMT_1", "LINE_NCH_PMT_AMT_2"), "carrier")


def test_numbered_columns_go_by_number(spark):
    source = frame(spark, HCPCS_CD_10=["a"], HCPCS_CD_2=["b"], HCPCS_CD_1=["c"])
    assert cms.columns_like(source, ("HCPCS_CD_",)) == ["HCPCS_CD_1", "HCPCS_CD_2", "HCPCS_CD_10"]


def test_prescriptions_have_no_provider(spark):
    source = frame(
        spark,
        DESYNPUF_ID=["BENE03"],
        PDE_ID=["3003"],
        SRVC_DT=["20100307"],
        PROD_SRVC_ID=["00011122233"],
        QTY_DSPNSD_NUM=["30.7"],
        DAYS_SUPLY_NUM=["30"],
        TOT_RX_CST_AMT=["89.40"],
    )
    row = cms.adapt_cms(source, "pde").first()
    assert (row["claim_type"], row["units"], row["procedure_count"]) == ("pharmacy", 30, 1)
    assert row["provider_id"] == "CMS-NO-PROVIDER-CMS-PHARMACY-3003"


def test_segments_collapse(spark):
    source = frame(
        spark,
        DESYNPUF_ID=["BENE04", "BENE04", "OTHER"],
        CLM_ID=["4004", "4004", "4004"],
        SEGMENT=["2", "1", "10"],
        CLM_FROM_DT=["20090101", "20090103.0", "20090102"],
        PRVDR_NUM=["LATE", "FIRST", "LAST"],
        CLM_PMT_AMT=["900", "950.555", "100"],
        HCPCS_CD_1=["71020", "71020", None],
    )
    rows = cms.adapt_cms(source, "outpatient").collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row["source_record_count"], row["provider_id"]) == (3, "CMS-PRV-FIRST")
    assert row["beneficiary_id"] == "CMS-BEN-BENE04"
    assert row["paid_amount"] == pytest.approx(950.56, abs=0.011)
    assert str(row["service_date"])[:10] == "2009-01-01"


def test_first_skips_nulls(spark):
    rows = [("C", None, "b2", 1), ("C", "x", None, 2), ("C", "y", "b1", 3)]
    table = spark.createDataFrame(rows, "claim_id string, provider_id string, beneficiary_id string, at int")
    found = table.groupBy("claim_id").agg(cms.first_by("provider_id", F.col("at")), cms.first_by("beneficiary_id", F.col("at")))
    assert tuple(found.first()) == ("C", "x", "b2")


def test_missing_columns_and_ids(spark):
    with pytest.raises(ValueError, match="DESYNPUF_ID"):
        cms.adapt_cms(frame(spark, CLM_ID=["5"], CLM_FROM_DT=["20090101"]), "outpatient")
    source = frame(spark, DESYNPUF_ID=["nan"], CLM_ID=["5"], CLM_FROM_DT=["20090101"], CLM_PMT_AMT=["1"])
    with pytest.raises(Exception, match="DESYNPUF_ID must not be missing"):
        cms.adapt_cms(source, "outpatient").collect()


def test_bad_dates_stop_the_job_and_are_reported_first(spark):
    source = frame(
        spark,
        DESYNPUF_ID=["B"] * 4,
        CLM_ID=["1", "2", "3", " "],
        CLM_FROM_DT=["2009-01-01", "20091341", None, "20090101"],
        CLM_PMT_AMT=["1"] * 4,
    )
    with pytest.raises(Exception, match="no YYYYMMDD date in CLM_FROM_DT"):
        cms.adapt_cms(source.filter("CLM_ID < '3' and CLM_ID > ' '"), "outpatient").collect()
    with pytest.raises(Exception, match="no YYYYMMDD date in CLM_FROM_DT"):
        cms.adapt_cms(source.filter("CLM_ID < '3' and CLM_ID > ' '"), "outpatient").agg({"paid_amount": "sum"}).collect()
    found = {r["problem"]: (r["rows"], r["examples"]) for r in cms.source_problems(source, "outpatient").collect()}
    assert found == {"missing CLM_ID": (1, []), "invalid CLM_FROM_DT": (2, ["2009-01-01", "20091341"])}


def test_type_names(spark):
    assert [cms.claim_kind(n) for n in (" PDE ", "Prescription", "carrier")] == ["pharmacy", "pharmacy", "carrier"]
    with pytest.raises(ValueError, match="unknown kind"):
        cms.claim_kind("dental")


def test_column_names(spark):
    assert cms.with_plain_names(frame(spark, **{" clm_id ": ["1"]})).columns == ["CLM_ID"]
    with pytest.raises(ValueError, match="share a name"):
        cms.with_plain_names(spark.createDataFrame([("1", "2")], ["CLM_ID", "clm_id "]))


def write_csv(path, header, rows):
    path.write_text("\n".join([header, *rows]) + "\n")
    return str(path)


def test_csv_header_clash(spark, tmp_path):
    path = write_csv(tmp_path / "a.csv", "CLM_ID,clm_id", ["1,2"])
    with pytest.raises(ValueError, match="share a name"):
        cms.read_cms_csv(spark, path)


def test_csv_to_claims_and_back(spark, tmp_path):
    header = "DESYNPUF_ID,CLM_ID,CLM_FROM_DT,PRVDR_NUM,CLM_PMT_AMT,ICD9_DGNS_CD_1,HCPCS_CD_1"
    rows = [f"BENE{i:04d},CLM{i:04d},20090101,PRV{i % 20:03d},{100 + 3 * i},4019,N/A" for i in range(120)]
    # Without segment numbers the first row of the file wins.
    rows.append("BENE9999,CLM0000,20081231,PRV999,50,,99213")
    path = write_csv(tmp_path / "outpatient.csv", header, rows)
    claims = cms.ingest_cms_csv(spark, path, "outpatient", str(tmp_path / "canonical"), fmt="csv")
    assert claims.count() == 120
    check_claims(claims)
    row = claims.filter("source_claim_id = 'CLM0000'").first()
    assert (row["provider_id"], row["source_record_count"], row["procedure_count"]) == ("CMS-PRV-PRV000", 2, 1)
    assert str(row["service_date"]) == "2008-12-31 00:00:00"
    again = read_claims(spark, str(tmp_path / "canonical"), "csv")
    assert dict(again.dtypes)["paid_amount"] == "double" and dict(again.dtypes)["units"] == "bigint"
    parquet = cms.ingest_cms_csv(spark, path, "outpatient", str(tmp_path / "parquet"))
    assert sorted(parquet.select(*again.columns).collect(), key=str) == sorted(again.collect(), key=str)


def test_short_csv_rows_end_in_nulls(spark, tmp_path):
    path = write_csv(tmp_path / "a.csv", "A,B,C", ["1,2,3", "4,5", '"6, and 7",8,'])
    rows = [tuple(r) for r in read_text_csv(spark, path).collect()]
    assert rows == [("1", "2", "3"), ("4", "5", None), ("6, and 7", "8", None)]


@pytest.mark.parametrize(
    ("row", "message"), [("3,4,5", "more cells than the header"), ('3,4,"5,6",7', "more cells"), ('"x', "inside quotes")]
)
def test_csv_rows_that_would_lose_cells_stop_the_job(spark, tmp_path, row, message):
    table = read_text_csv(spark, write_csv(tmp_path / "a.csv", "A,B", ["1,2", row]))
    for read in (table.collect, table.count, table.select("B").collect, table.agg(F.max("A")).collect):
        with pytest.raises(Exception, match=message):
            read()


def test_csv_line_breaks_inside_quotes(spark, tmp_path):
    path = write_csv(tmp_path / "a.csv", "A,B", ['"x', 'y",7', "1,2"])
    with pytest.raises(Exception, match="inside quotes"):
        read_text_csv(spark, path).count()
    rows = [tuple(r) for r in read_text_csv(spark, path, multi_line=True).collect()]
    assert rows == [("x\ny", "7"), ("1", "2")]
    wide = write_csv(tmp_path / "b.csv", "A,B", ['"x', 'y",7,8'])
    with pytest.raises(Exception, match="more cells"):
        read_text_csv(spark, wide, multi_line=True).count()


def test_extract_without_claims_is_refused(spark, tmp_path):
    path = write_csv(tmp_path / "a.csv", "DESYNPUF_ID,PDE_ID,SRVC_DT,PROD_SRVC_ID,QTY_DSPNSD_NUM,TOT_RX_CST_AMT", [])
    with pytest.raises(ValueError):
        cms.ingest_cms_csv(spark, path, "pharmacy", str(tmp_path / "out"))
