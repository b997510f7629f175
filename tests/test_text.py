from staylink.functions.text import fold_title, normalize_host, normalize_title
from staylink.operators.filters import derive_type, parse_result_count


def test_titles(spark):
    df = spark.createDataFrame([("Casa Señorial (vistas)",), (None,), ("  Villa\tBonita  ",)], "t string")
    got = df.select(normalize_title("t"), fold_title("t"), normalize_title("t", null_text=""),
                    normalize_host("t")).collect()
    assert tuple(got[0]) == ("casa se orial vistas", "casa senorial (vistas)", "casa se orial vistas",
                             "casa señorial (vistas)")
    assert tuple(got[1]) == ("nan", "", "", "nan")
    assert tuple(got[2])[:2] == ("villa bonita", "villa bonita")


def test_result_count_and_type(spark):
    df = spark.createDataFrame([("Más de 1.000 alojamientos",), ("1.286 alojamientos",), ("Sin resultados",),
                                (None,)], "t string")
    assert [r[0] for r in df.select(parse_result_count("t")).collect()] == [1000, 1286, 0, -1]
    df2 = spark.createDataFrame([("Casa en Sóller",), ("Apto. Playa",), ("",), (None,), ("Villa x",)], "t string")
    assert [r[0] for r in df2.select(derive_type("t")).collect()] == ["Casa rural", "Apartamento", "", "", "Villa"]
