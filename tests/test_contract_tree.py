"""Nested contracts: every kind of node, nulls and empty values, by path."""

from catalograph.operators.contract_tree import Node, tree_violations


def test_paths_of_all_kinds(spark):
    tree = {"a": Node(fields={"b": Node(enum=("x",)), "c": Node(required=False, const=1)}),
            "d": Node(min_items=1, max_items=2, items=Node(items=Node(minimum=0, maximum=9))),
            "e": Node(required=False, keys=Node(pattern="^k"), values=Node(readable="date")),
            "f": Node(values=Node(fields={"g": Node(readable="integer", minimum=5)}))}
    schema = "id int, a struct<b:string,c:int>, d array<array<int>>, e map<string,string>, f map<string,struct<g:string>>"
    rows = [(1, ("x", 1), [[0, 9]], {"k1": "2024-02-29"}, {"p": ("5",)}),
            (2, ("y", 2), [], {"z": "2024-02-30", "k": None}, {"p": ("4",), "q": (None,), "r": None, "s": ("x",)}),
            (3, None, [[1], None, [10, -1, None]], None, None), (4, (None, None), None, {}, {})]
    found = tree_violations(spark.createDataFrame(rows, schema), ["id"], tree).collect()
    assert {tuple(r) for r in found} == {
        (2, "a.b", "enum"), (2, "a.c", "const"), (2, "d", "minItems"), (2, "e{z}", "pattern"), (2, "e{z}", "type"), (2, "e{k}", "required"),
        (2, "f{p}.g", "minimum"), (2, "f{q}.g", "required"), (2, "f{r}", "required"), (2, "f{s}.g", "type"),
        (3, "a", "required"), (3, "d", "maxItems"), (3, "d[1]", "required"), (3, "d[2][0]", "maximum"), (3, "d[2][1]", "minimum"),
        (3, "d[2][2]", "required"), (3, "f", "required"), (4, "a.b", "required"), (4, "d", "required")}
    assert len(found) == 19
    plan = tree_violations(spark.createDataFrame(rows, schema), ["id"], tree)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan.replace("ExistingRDD", "")
