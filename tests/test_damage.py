"""Damage by position: the word in field 4, the dropped last field."""

from tillroll.sources.damage import corrupt_fields, corrupt_lines


def test_both_forms_damage_alike(spark):
    rows = [(p, f"f{p}", "b", "c", "d", "e", "g", "h") for p in range(0, 60)]
    names = ["a", "b", "c", "d", "e", "g", "h"]
    fields = spark.createDataFrame(rows, "position long, " + ", ".join(f"{n} string" for n in names))
    joined = corrupt_fields(fields, names, period=5).selectExpr("position", f"concat_ws(',', {', '.join(names)}) AS value")
    lines = corrupt_lines(fields.selectExpr("position", f"concat_ws(',', {', '.join(names)}) AS value"), period=5)
    expected = {}
    for p, *parts in rows:
        if p > 0 and p % 5 == 0:
            parts[4] = "N/A"
        elif p > 5 and p % 15 == 1:
            parts = parts[:-1]
        expected[p] = ",".join(parts)
    assert {r.position: r.value for r in lines.collect()} == expected
    assert {r.position: r.value for r in joined.collect()} == expected
