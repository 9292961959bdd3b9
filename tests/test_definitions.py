"""Documents flattened and definitions inherited, against rows worked out by hand and a plain fold."""

import json
import random

import pytest

from cinderlane.operators import definitions

FACT = "node string, field string, number double, text string"


def test_flatten_by_hand(spark):
    docs = [
        (1, '{"a":{"b":[1,"2",{"c":"TRUE"}],"e":[],"f":{},"n":null,"s":"","t":"x y"},"k":false,"big":1e400}'), (2, "not json"), (3, '[[1.5,"1_000"," 7 ","nan","1e999","1__0","._1","5."]]'),
        (4, None), (5, '"abc"'), (6, '"1d"'), (7, "[]"), (8, "{}"), (9, "12"), (9, "12"), (10, '{"x":1,"x":2}'), (None, '{"path":"kind","_v":[null]}'),
    ]
    got = sorted(tuple(r) for r in definitions.flatten(spark.createDataFrame(docs, "id int, doc string"), ["id"], "doc").collect() if r.id is not None)
    want = [
        (1, "a.b[0]", "number", 1.0, None), (1, "a.b[1]", "number", 2.0, None), (1, "a.b[2].c", "boolean", 1.0, None), (1, "a.e", "empty_list", None, ""), (1, "a.t", "string", None, "x y"),
        (1, "k", "boolean", 0.0, None), (1, "big", "nonfinite", None, None), (2, "", "invalid", None, "not json"), (3, "[0][0]", "number", 1.5, None), (3, "[0][1]", "number", 1000.0, None),
        (3, "[0][2]", "number", 7.0, None), (3, "[0][3]", "string", None, "nan"), (3, "[0][4]", "string", None, "1e999"), (3, "[0][5]", "string", None, "1__0"), (3, "[0][6]", "string", None, "._1"), (3, "[0][7]", "number", 5.0, None),
        (5, "", "string", None, "abc"), (6, "", "string", None, "1d"), (7, "", "empty_list", None, ""), (9, "", "number", 12.0, None), (9, "", "number", 12.0, None), (10, "", "invalid", None, '{"x":1,"x":2}'),
    ]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert definitions.flatten(spark.createDataFrame([], "id int, doc string"), ["id"], "doc").isEmpty()
    deep = json.dumps({"a": "[" * 5}).replace('"[[[[["', "[" * 30 + "]" * 30)
    assert [r.path for r in definitions.flatten(spark.createDataFrame([(1, deep)], "id int, doc string"), ["id"], "doc").collect()] == ["a" + "[0]" * 29]
    with pytest.raises(ValueError, match="deeper"):
        definitions.flatten(spark.createDataFrame([(1, deep)], "id int, doc string"), ["id"], "doc", most=4)


def test_names_of_bases(spark):
    rows = [
        ("F.a", "x", 1.0, None), ("F.b", "Base", None, "a"), ("G.c", "Base", None, "F.a"), ("G.d", "Base", None, "b"), ("H.e", "Base", None, "Q.b"), ("F.twin", "x", 1.0, None), ("G.twin", "x", 1.0, None), ("H.f", "Base", None, "twin"),
        ("F.g", "Base", None, "twin"), ("AEO.t", "x", 1.0, None), ("AREA_EFFECT_OBJECT.t", "x", 1.0, None), ("AEO.h", "Base", None, "t"), ("AREA_EFFECT_OBJECT.i", "Base", None, "t"), ("EXT.j", "Base", None, "F.a"),
        ("H.k", "Base", None, "F.j"), ("H.l", "Base", None, "G.j"), ("H.m", "Base", None, ""), ("H.n", "Base", 3.0, None), ("H.o", "Base", None, "a"), ("H.o", "Base", None, "b"),
    ]
    got = {r.node: (r.parent, r.how) for r in definitions.resolved_bases(definitions.facts(spark.createDataFrame(rows, FACT))).collect()}
    assert got == {
        "F.b": ("F.a", "family"), "G.c": ("F.a", "qualified"), "G.d": ("F.b", "unique"), "H.e": ("F.b", "unique"), "H.f": (None, "unknown"), "F.g": ("F.twin", "family"), "AEO.h": (None, "unknown"), "AREA_EFFECT_OBJECT.i": (None, "unknown"),
        "EXT.j": ("F.a", "qualified"), "H.k": ("EXT.j", "extension"), "H.l": ("EXT.j", "unique"),
    }


def fold(own, parent, node):
    """A node's fields, its base's first."""
    out = dict(fold(own, parent, parent[node])) if parent.get(node) else {}
    local, clash = own[node]
    out.update(local)
    for f, sign in local.items():
        if f.endswith("[0]") and sign in ("+", "-", "*", "/", "="):
            name, operand, old = f[:-3], local.get(f[:-3] + "[1]"), out.get(f[:-3])
            if sign == "=" and isinstance(operand, float):
                out[name] = operand
            elif sign == "+" and isinstance(operand, float) and isinstance(old, float):
                out[name] = old + operand
            else:
                out.pop(name, None)
    for f in clash:
        out.pop(f, None)
    return out


def test_chains_against_a_plain_fold(spark):
    rng, own, parent, rows = random.Random(6), {}, {}, []
    names = [f"F.n{i}" for i in range(90)]
    for i, node in enumerate(names):
        local, clash = {}, set()
        for f in ("Hit", "Cost", "Name"):
            if rng.random() < 0.3:
                local[f] = float(rng.randrange(50)) if f != "Name" or rng.random() < 0.3 else "text"
            if rng.random() < 0.4:
                local[f + "[0]"] = rng.choice(["+", "+", "+", "=", "*", "odd", 7.0])
            if rng.random() < 0.5:
                local[f + "[1]"] = rng.choice([1.0, 2.5, "x"])
            if rng.random() < 0.05:
                local.pop(f, None)
                clash.add(f)
        if i and rng.random() < 0.97:
            parent[node] = names[i - 1] if i % 10 else names[rng.randrange(i)]  # chains of ten and more
            local["Base"] = parent[node]
        own[node] = local, clash
        rows += [(node, f, v, None) if isinstance(v, float) else (node, f, None, v) for f, v in local.items()] + [(node, f, v, None) for f in clash for v in (1.0, 2.0)]
    got = {}
    for r in definitions.effective(spark.createDataFrame(rows + rows[:20], FACT)).collect():
        got.setdefault(r.node, {})[r.field] = r.number if r.number is not None else r.text
    want = {n: fold(own, parent, n) for n in names}
    assert got == {n: v for n, v in want.items() if v}


def test_aliases_and_cycles(spark):
    rows = [("F.a", "Hit", 10.0, None), ("EXT.e", "Base", None, "F.a"), ("EXT.e", "Hit[0]", None, "+"), ("EXT.e", "Hit[1]", 2.0, None), ("G.z", "Base", None, "F.e"), ("G.z", "Hit[0]", None, "="), ("G.z", "Hit[1]", 3.0, None)]
    got = {(r.node, r.field): r.number for r in definitions.effective(spark.createDataFrame(rows, FACT)).collect() if r.field == "Hit"}
    assert got == {("F.a", "Hit"): 10.0, ("EXT.e", "Hit"): 12.0, ("F.e", "Hit"): 12.0, ("G.z", "Hit"): 3.0}
    with pytest.raises(ValueError, match="themselves"):
        definitions.effective(spark.createDataFrame([("F.a", "Base", None, "F.b"), ("F.b", "Base", None, "F.a"), ("F.c", "x", 1.0, None)], FACT))
    assert definitions.effective(spark.createDataFrame([], FACT)).isEmpty()
