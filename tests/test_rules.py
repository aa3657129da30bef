from conftest import rows
from pyspark.sql import functions as F

from tideline.functions.rules import Rule, categorise
from tideline.plans import permits


def categories(spark, pairs, rules):
    frame = spark.createDataFrame([(i, t, o) for i, (t, o) in enumerate(pairs)], "i int, type string, occupancy_group string")
    return [r[1] for r in rows(frame.select("i", categorise(rules, F.col("type"))), "i")]


def test_first_rule_wins_and_otherwise_keeps_the_value(spark):
    rules = [Rule("one", equals={"type": ["a", "b"]}), Rule("two", equals={"type": ["b", "c"]})]
    assert categories(spark, [("a", None), ("b", None), ("c", None), ("d", None), (None, None)], rules) == [
        "one", "one", "two", "d", None,
    ]


def test_structure_categories(spark):
    pairs = {
        "Townhouse (3 or more units)": "Rowhouse, Townhouse, Duplex",
        "Rowhouse (2 units)": "Rowhouse, Townhouse, Duplex",
        "Apartments/Condos (3 or more units)": "Apartments",
        "Floating Home": "Single Family Detached",
        "Garage/Carport": "Accessory Structures",
        "Something else": "Something else",
    }
    assert categories(spark, [(t, None) for t in pairs], permits.STRUCTURE_RULES) == list(pairs.values())


def test_function_categories_by_prefix_and_type(spark):
    cases = [
        (("x", "A-2"), "Commercial"),
        (("Hotel/Motel", None), "Commercial"),
        (("x", "R-1"), "Residential"),  # a one-character prefix is never 'R-1'
        (("x", "B"), "Office"),
        (("School", "Z"), "School"),
        (("x", "H-3"), "Industrial"),
        (("x", "I-2"), "Healthcare"),
        (("Apartments/Condos", None), "Residential"),
        (("x", "U"), "Utility, Storage, Parking, Special"),
        (("x", "U1"), "x"),  # a two-character prefix is 'U' only for the bare code
        (("x", "SR"), "Utility, Storage, Parking, Special"),
        (("Storage", None), "Utility, Storage, Parking, Special"),
        (("Duplex", "E"), "School"),
        ((None, None), None),
    ]
    assert categories(spark, [pair for pair, _ in cases], permits.FUNCTION_RULES) == [want for _, want in cases]
