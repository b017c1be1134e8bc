"""Cross-domain insight: golden values from the constant summaries."""

import json

import pytest

from opslens.operators import insight

# The fields that X1-X3 read in the source's two constant summaries.
MFG = {"total_machines_analyzed": 100, "high_risk_machines": 15, "average_machine_efficiency": 0.87,
       "data_quality_score": 0.95}
ECOM = {"total_customers_analyzed": 1000, "high_value_customers": 150, "customer_satisfaction_index": 8.3,
        "data_quality_score": 0.96}
# Own values for fields that are only carried along.
CARRIED = {"predicted_maintenance_events": 3, "most_popular_category": "hats", "timestamp": 1.75e9}

GOLDEN = [  # (mfg present, ecom present) -> (opex, health, quality)
    (True, True, (0.854, 0.5, 0.955)),
    (False, False, (0.0, 0.5, 0.0)),
    (True, False, (0.522, 0.425, 0.475)),
    (False, True, (0.332, 0.575, 0.48)),
]


def summary_df(spark, values, schema):
    return spark.createDataFrame([tuple(values.get(f.name, CARRIED.get(f.name)) for f in schema.fields)], schema)


@pytest.mark.parametrize("has_mfg,has_ecom,expected", GOLDEN)
def test_golden(spark, has_mfg, has_ecom, expected):
    mfg = summary_df(spark, MFG, insight.MFG_SUMMARY_SCHEMA) if has_mfg else None
    ecom = summary_df(spark, ECOM, insight.ECOM_SUMMARY_SCHEMA) if has_ecom else None
    row = insight.cross_domain(spark, mfg, ecom).first()
    got = (row.operational_excellence_score, row.business_health_index, row.data_quality_composite)
    assert got == pytest.approx(expected)


def test_empty_summary_reads_as_missing(spark):
    empty = summary_df(spark, MFG, insight.MFG_SUMMARY_SCHEMA).limit(0)
    ecom = summary_df(spark, ECOM, insight.ECOM_SUMMARY_SCHEMA)
    row = insight.cross_domain(spark, empty, ecom).first()
    assert (row.operational_excellence_score, row.business_health_index) == pytest.approx((0.332, 0.575))


def test_integrated_document(spark):
    mfg = summary_df(spark, MFG, insight.MFG_SUMMARY_SCHEMA)
    doc = json.loads(insight.integrate(spark, mfg, None).toJSON().first())
    assert doc["manufacturing_metrics"]["high_risk_machines"] == 15
    assert doc["manufacturing_metrics"]["timestamp"] == 1.75e9 and doc["manufacturing_metrics"]["predicted_maintenance_events"] == 3
    assert doc["ecommerce_metrics"] == {}  # a missing summary is an empty object
    assert doc["cross_domain_insights"]["data_quality_composite"] == pytest.approx(0.475)
    assert doc["timestamp"] > 1.6e9


def test_zero_total_raises(spark):
    bad = dict(MFG, total_machines_analyzed=0)
    mfg = summary_df(spark, bad, insight.MFG_SUMMARY_SCHEMA)
    with pytest.raises(Exception):
        insight.cross_domain(spark, mfg, None).collect()
