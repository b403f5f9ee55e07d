import pytest

from tallyspark.operators.split import explode_packed

NAMES = ["Bureau of Reefs, Kelp and Estuaries", "Commission on Bells; Clocks and Dials", "Interstate Mast/Tower Panel", 'Office of "Dry Canal" Works', "Plain Office"]
CASES = {
    "A,B ,C": ["A", "B", "C"],
    " A ; ;B|C/D\nE\r\nF\tG,": ["A", "B", "C", "D", "E", "F", "G"],
    "BUREAU OF REEFS, KELP AND ESTUARIES, ABC": ["BUREAU OF REEFS, KELP AND ESTUARIES", "ABC"],
    'X, "Commission on Bells; Clocks and Dials" and Y': ["X", "Commission on Bells; Clocks and Dials", "Y"],
    'A, and "B, C"': ["A", "B, C"],
    "'A; B', Interstate Mast/Tower Panel/C": ["A; B", "Interstate Mast/Tower Panel", "C"],
    '"Office of ""Dry Canal"" Works", Office of "Dry Canal" Works': ['Office of "Dry Canal" Works'] * 2,
    "1) A 2) B, C 3) D": ["A", "B", "C", "D"],
    "(1) A; (2) B": ["A", "B"],
    "- A\n- B": ["A", "B"],
    '["A, B", "C \\"D\\" E"]': ["A, B", 'C "D" E'],
    "['A', 'B']": ["A", "B"],
    "Alpine Sands Office": ["Alpine Sands Office"],
    "A0.0,B": ["A0.0", "B"],
    "": [], "   ": [], ",;|": [], '""': [],
    'unclosed "quote, B': ['unclosed "quote', "B"],
}


@pytest.mark.parametrize("text", CASES)
def test_cases(spark, text):
    df = spark.createDataFrame([(1, text, "clash")], "id long, packed string, pos string")
    out = [tuple(r) for r in explode_packed(df, "id", "packed", NAMES).orderBy("pos").collect()]
    assert out == [(1, i + 1, p) for i, p in enumerate(CASES[text])]


def test_null_empty_table_and_long(spark):
    schema = "id long, packed string"
    assert explode_packed(spark.createDataFrame([], schema), "id", "packed", NAMES).count() == 0
    assert explode_packed(spark.createDataFrame([(1, None)], schema), "id", "packed").count() == 0
    long = ",".join(f"part {i}" for i in range(20_000))
    assert explode_packed(spark.createDataFrame([(1, long), (1, long)], schema), "id", "packed").count() == 40_000
