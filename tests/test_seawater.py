"""Published check values, independent of the SQL."""

import pytest
from pyspark.sql import functions as F

from fathomline.functions import seawater as sw


def value(spark, expression):
    return spark.range(1).select(F.expr(expression).alias("v")).first()[0]


@pytest.mark.parametrize("expression, expected, tolerance", [
    (sw.density("34.7118D", "28.8099D", "10D"), 1021.839935738108, 1e-9),
    (sw.density("34.7324D", "4.3236D", "1000D"), 1032.002453224572, 1e-9),
    (sw.depth_from_pressure("10D", 4.0), 9.9445834469453, 1e-9),
    (sw.depth_from_pressure("1000D", 4.0), 992.0919060719987, 1e-9),
    (sw.oxygen_solubility("34.5487D", sw.oxygen_log("28.78319681967063D")), 194.96507778, 1e-7),
    (sw.oxygen_mgkg("10D", "35D", "95D"), 8.347067176716, 1e-11),
    (sw.oxygen_mgl("10D", "35D", "95D"), 8.571701398667, 1e-11),
    (sw.salinity_15c("4D"), 32.356431785151, 1e-11),
])
def test_formula(spark, expression, expected, tolerance):
    assert value(spark, expression) == pytest.approx(expected, abs=tolerance)


@pytest.mark.parametrize("ratio, t68, p, expected", [
    (1.0, 15.0, 0.0, 35.0), (1.2, 20.0, 2000.0, 37.245628), (0.65, 5.0, 1500.0, 27.995347)])
def test_practical_salinity(spark, ratio, t68, p, expected):
    t90 = f"{t68 / 1.00024!r}D"
    root = sw.ratio_root(f"{ratio}D", t90, f"{p}D")
    assert value(spark, sw.practical_salinity(root, t90)) == pytest.approx(expected, abs=1e-6)


def chain(spark, rows):
    df = spark.createDataFrame(rows, "salinity_psu double, temperature_C double, pressure_dbar double")
    return sw.with_properties(df).collect()


def test_published_conservative_temperature(spark):
    sp = [34.7118 * 35 / 35.16504, 34.7324 * 35 / 35.16504]
    a, b = chain(spark, [(sp[0], 28.7856, 10.0), (sp[1], 4.4036, 1000.0)])
    assert a["_CT"] == pytest.approx(28.809919826700281, abs=1e-11)
    assert b["_CT"] == pytest.approx(4.323575748610455, abs=1e-11)
    assert a["pot_temp_C"] == pytest.approx(28.78319681967063, abs=1e-10)


def test_chain_and_missing_values(spark):
    full, gap = chain(spark, [(35.0, 10.0, 100.0), (None, 10.0, 100.0)])
    assert full["_SA"] == pytest.approx(35.16504)
    assert full["pot_temp_C"] == pytest.approx(9.98844127788, abs=1e-10)
    assert full["_CT"] == pytest.approx(9.97825825840, abs=1e-10)
    assert full["density_kg_m3"] == pytest.approx(1027.40614906251, abs=1e-9)
    assert gap["pot_temp_C"] is None and gap["density_kg_m3"] is None


def test_anomaly_ratio(spark):
    df = spark.createDataFrame([(35.0, 10.0, 100.0, 0.001)], "salinity_psu double, temperature_C double, "
                                                            "pressure_dbar double, saar double")
    assert sw.with_properties(df, saar="saar").first()["_SA"] == pytest.approx(35.16504 * 1.001)


def test_buoyancy_frequency(spark):
    row = spark.createDataFrame([(34.7118, 28.8099, 10.0, 34.8915, 28.4392, 50.0),
                                 (34.7, 20.0, 10.0, 34.8, 19.0, 10.0)],
                                "_SA double, _CT double, _p double, next__SA double, next__CT double, next__p double")
    first, same_pressure = sw.with_buoyancy(row).collect()
    # Published for latitude 4: 0.060846990882908e-3; the gravity ratio makes up the difference.
    assert first["N2"] == pytest.approx(0.0608e-3, rel=5e-3)
    assert same_pressure["N2"] is None
