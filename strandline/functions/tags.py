"""Key maps and filter lists kept as text: ``K=V;K=V`` and ``A;B``, a dot for none."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _once(value: Column, body) -> Column:
    """``body(value)`` with value worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def parsed(info: Column) -> Column:
    """Map of a text of pairs; keys without a value map to an empty text. Of repeated keys the last counts."""
    pairs = F.filter(F.split(F.coalesce(info, F.lit("")), ";"), lambda x: (x != "") & (x != "."))
    entries = F.transform(pairs, lambda x: F.struct(F.substring_index(x, "=", 1).alias("k"), F.when(F.contains(x, F.lit("=")), F.substring(x, F.instr(x, "=") + 1, F.length(x))).otherwise("").alias("v")))

    def last(own: Column) -> Column:
        keys = F.transform(own, lambda e: e["k"])
        # where keys repeat: the place of a key from the end says whether it is the last one
        kept = F.filter(own, lambda e, i: F.size(own) - F.array_position(F.reverse(F.transform(own, lambda o: o["k"])), e["k"]).cast("int") == i)
        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), own).otherwise(kept)

    return F.map_from_entries(_once(entries, last))


def text_of(entries: Column) -> Column:
    """The text of a map, by key; an empty value becomes a dot, no entries too."""
    rows = F.sort_array(F.map_entries(entries))
    joined = F.array_join(F.transform(rows, lambda e: F.concat(e["key"], F.lit("="), F.when(e["value"] == "", ".").otherwise(e["value"]))), ";")
    return F.when(joined == "", ".").otherwise(joined)


def updated(info: Column, changes: dict[str, Column]) -> Column:
    """The text of a map, as ``parsed`` gives it, with keys set; a null value removes its key."""
    own = F.map_filter(info, lambda k, v: ~k.isin(*changes)) if changes else info
    new = F.map_filter(F.create_map(*[x for k, v in changes.items() for x in (F.lit(k), v.cast("string"))]), lambda k, v: v.isNotNull())
    return text_of(F.map_concat(own, new))


def value(info: Column, key: str, kind: str = "string", default=None) -> Column:
    """A key's value in a map, as ``parsed`` gives it; the word None counts as none."""
    found = F.try_element_at(info, F.lit(key))
    typed = F.when(found != "None", found).try_cast(kind)
    return typed if default is None else F.coalesce(typed, F.lit(default).cast(kind))


def filters(text: Column) -> Column:
    return F.sort_array(F.array_distinct(F.filter(F.split(F.coalesce(text, F.lit("")), ";"), lambda x: (x != "") & (x != "."))))


def with_filter(text: Column, name: str, number: Column, low: float = float("-inf"), high: float = float("inf")) -> Column:
    """The filter list with ``name`` where the number is null or outside [low, high], without it elsewhere."""
    bad = number.isNull() | (number < low) | (number > high)
    own = F.filter(filters(text), lambda x: x != name)
    out = F.array_join(F.sort_array(F.when(bad, F.array_union(own, F.array(F.lit(name)))).otherwise(own)), ";")
    return F.when(out == "", ".").otherwise(out)


def break_distance(contig1: Column, stop1: Column, contig2: Column, start2: Column) -> Column:
    """Null on different contigs, where the distance is unbounded."""
    return F.when(contig1 == contig2, start2 - stop1)


def swapped(df, when: Column):
    """df with the columns that end in 1 and in 2 exchanged where the condition holds."""
    pairs = [(c, f"{c[:-1]}2") for c in df.columns if c.endswith("1") and f"{c[:-1]}2" in df.columns]
    return df.withColumns({**{a: F.when(when, F.col(b)).otherwise(F.col(a)) for a, b in pairs}, **{b: F.when(when, F.col(a)).otherwise(F.col(b)) for a, b in pairs}})


def alarms(metrics, rules: list[dict]):
    """(id, message, level) of rules (id, when, format, level, parent) over a one-row table of metrics. A rule on a null metric isn't raised; nor is one below a raised parent. ``when`` and ``format`` are the caller's own SQL expressions."""
    raised = metrics.select(*[F.coalesce(F.expr(r["when"]), F.lit(False)).alias(r["id"]) for r in rules], *[F.expr(r["format"]).cast("string").alias(f"{r['id']}__text") for r in rules])
    up = {r["id"]: r.get("parent") for r in rules}

    def above(i):
        chain, seen = [], {i}
        while (i := up.get(i)) and i not in seen:
            chain.append(i)
            seen.add(i)
        return chain

    rows = [F.when(F.col(r["id"]) & ~reduce(lambda x, y: x | y, [F.col(a) for a in above(r["id"])], F.lit(False)), F.struct(F.lit(r["id"]).alias("id"), F.col(f"{r['id']}__text").alias("message"), F.lit(r["level"]).alias("level"))) for r in rules]
    return raised.select(F.explode(F.array_compact(F.array(*rows))).alias("a")).select("a.*")
