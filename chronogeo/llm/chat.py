"""Chat formatting with tool-call linking.

A turn's text may be a JSON object: an assistant's {"content"?, "tool_calls": [{"id", "name", "arguments"}]}, or a tool's
{"tool_call_id", "content"}; a system turn may declare {"content"?, "tools": [{"name", "parameters": schema}]}.  Results
are hash-joined to calls by (conversation, identifier); each conversation's messages are ordered topologically (a result
after its call, a call after the results that its arguments refer to as "$id", otherwise by turn); arguments are
validated against the tool's schema; and each conversation becomes one line of canonical JSON (sorted keys, no spaces,
UTF-8).

The join tells for every identifier the places of its call and of its result in the conversation, where it has them; these
are what a conversation is then ordered by.  Only turns that may be JSON are parsed for it.
"""

from __future__ import annotations

import heapq
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_map, i64, table

COUNTS = ("n_calls", "n_linked", "n_unanswered", "n_orphans", "n_invalid", "n_cyclic")


def messages(conv: DataFrame) -> DataFrame:
    """conv_id, seq, role, text: the turns, numbered in each conversation by turn, role and text."""
    c = conv.select("conv_id", "turn", F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).where("conv_id is not null")
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return c.select("conv_id", (F.row_number().over(w) - 1).alias("seq"), "role", "text")


def _calls(role: str, x) -> list | None:
    return x["tool_calls"] if role == "assistant" and x and isinstance(x.get("tool_calls"), list) else None


def _answered(role: str, x) -> str | None:
    return x["tool_call_id"] if role == "tool" and x and isinstance(x.get("tool_call_id"), str) else None


def _id_of(call) -> str | None:
    return call["id"] if isinstance(call, dict) and isinstance(call.get("id"), str) else None


def identifiers(m: DataFrame) -> DataFrame:
    """(conv_id, seq, id, calls): the identifiers of calls, and of the calls that results answer."""

    def run(b: pa.RecordBatch):
        rows = []
        for conv, seq, role, text in zip(*(b.column(k).to_pylist() for k in ("conv_id", "seq", "role", "text"))):
            x = _object(text)
            rows += [(conv, seq, i, True) for c in _calls(role, x) or () if (i := _id_of(c)) is not None]
            if (i := _answered(role, x)) is not None:
                rows.append((conv, seq, i, False))
        cols = list(zip(*rows)) or [(), (), (), ()]
        yield pa.record_batch({"conv_id": pa.array(cols[0], pa.int64()), "seq": pa.array(cols[1], pa.int32()), "id": pa.array(cols[2], pa.string()), "calls": pa.array(cols[3], pa.bool_())})

    return arrow_map(m.where("role in ('assistant', 'tool') and instr(text, '{') > 0"), run, "conv_id long, seq int, id string, calls boolean")


def links(m: DataFrame) -> DataFrame:
    """The hash join of calls and results: (conv_id, id, call_at, result_at), the first places of each, or null."""
    i = identifiers(m)
    first = lambda calls, name: i.where(F.col("calls") == calls).groupBy("conv_id", "id").agg(F.min("seq").alias(name))
    return first(True, "call_at").join(first(False, "result_at").hint("shuffle_hash"), ["conv_id", "id"], "full_outer")


def validate(value, schema, path: str = "$") -> list[str]:
    """What is wrong with a value under a JSON schema (type, enum, required, properties, additionalProperties, items, bounds)."""
    if not isinstance(schema, dict):
        return []
    kinds = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None), "integer": int, "number": (int, float)}
    want, bad = schema.get("type"), []
    if want is not None:
        names = [x for x in (want if isinstance(want, list) else [want]) if isinstance(x, str) and x in kinds]
        fits = any(isinstance(value, kinds[x]) and not (x in ("integer", "number") and isinstance(value, bool)) for x in names)
        if names and not fits:
            return [f"{path}: not {'|'.join(names)}"]
    if isinstance(schema.get("enum"), list) and value not in schema["enum"]:
        bad.append(f"{path}: not in enum")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if isinstance(schema.get("minimum"), (int, float)) and value < schema["minimum"]:
            bad.append(f"{path}: below minimum")
        if isinstance(schema.get("maximum"), (int, float)) and value > schema["maximum"]:
            bad.append(f"{path}: above maximum")
    if isinstance(value, dict):
        props = schema.get("properties") if isinstance(schema.get("properties"), dict) else {}
        req = schema.get("required") if isinstance(schema.get("required"), list) else []
        bad += [f"{path}.{k}: missing" for k in req if isinstance(k, str) and k not in value]
        for k in sorted(value):
            if k in props:
                bad += validate(value[k], props[k], f"{path}.{k}")
            elif schema.get("additionalProperties") is False:
                bad.append(f"{path}.{k}: unknown")
    if isinstance(value, list):
        for i, x in enumerate(value):
            bad += validate(x, schema.get("items"), f"{path}[{i}]")
    return bad


def canonical(x) -> str:
    return json.dumps(x, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def _object(text: str):
    if text.lstrip()[:1] != "{":
        return None
    try:
        x = json.loads(text)
    except (ValueError, RecursionError):
        return None
    return x if isinstance(x, dict) else None


def _text(x) -> str:
    return x if isinstance(x, str) else "" if x is None else canonical(x)


def _refs(x) -> set[str]:
    if isinstance(x, str):
        return {x[1:]} if x[:1] == "$" and len(x) > 1 else set()
    parts = x.values() if isinstance(x, dict) else x if isinstance(x, list) else ()
    return set().union(*map(_refs, parts)) if parts else set()


def conversation(turns: list[tuple[str, str]], linked: list[tuple[str, int | None, int | None]]) -> tuple[list[dict], dict[str, int]]:
    """Messages in topological order, and counts. turns: (role, text) in order; linked: (identifier, place of its call, of its result)."""
    counts = dict.fromkeys(COUNTS, 0)
    call_at = {i: c for i, c, _ in linked if c is not None}
    result_at = {i: r for i, _, r in linked if r is not None}
    schemas: dict[str, object] = {}
    nodes, needs = [], []
    for role, text in turns:
        x, need = _object(text), set()
        if role == "system" and x and isinstance(x.get("tools"), list):
            for t in x["tools"]:
                if isinstance(t, dict) and isinstance(t.get("name"), str):
                    schemas.setdefault(t["name"], t.get("parameters"))
            m = {"role": role, "content": _text(x.get("content")), "tools": x["tools"]}
        elif (found := _calls(role, x)) is not None:
            calls = []
            for c in found:
                cid = _id_of(c)
                c = c if isinstance(c, dict) else {"arguments": c}
                args = c.get("arguments")
                if isinstance(args, str):
                    try:
                        args = json.loads(args)
                    except (ValueError, RecursionError):
                        pass
                need |= _refs(args)
                calls.append({"id": cid, "name": c.get("name") if isinstance(c.get("name"), str) else None, "arguments": args})
                counts["n_calls"] += 1
            m = {"role": role, "content": _text(x.get("content")), "tool_calls": calls}
        elif (cid := _answered(role, x)) is not None:
            m = {"role": role, "content": _text(x.get("content")), "tool_call_id": cid}
        else:
            m = {"role": role, "content": text}
        nodes.append(m)
        needs.append(need)
    n = len(nodes)
    before: list[set[int]] = [set() for _ in range(n)]
    for i, m in enumerate(nodes):
        if "tool_call_id" in m:
            cid = m["tool_call_id"]
            if cid in call_at:
                before[i].add(call_at[cid])
                counts["n_linked"] += result_at[cid] == i
            else:
                counts["n_orphans"] += 1
        before[i] |= {result_at[c] for c in needs[i] if c in result_at}
        for c in m.get("tool_calls", ()):
            c["errors"] = validate(c["arguments"], schemas[c["name"]]) if c["name"] in schemas else ["unknown tool"]
            c["valid"] = not c["errors"]
            counts["n_invalid"] += not c["valid"]
            counts["n_unanswered"] += c["id"] not in result_at
    # Kahn's algorithm; the earliest message that is free goes first, and a cycle is broken at its earliest message
    after: list[list[int]] = [[] for _ in range(n)]
    left = [len(b) for b in before]
    for i, b in enumerate(before):
        for j in b:
            after[j].append(i)
    free = [i for i in range(n) if not left[i]]
    heapq.heapify(free)
    done, order, scan = [False] * n, [], 0
    while len(order) < n:
        if not free:
            while done[scan]:
                scan += 1
            counts["n_cyclic"] += 1
            heapq.heappush(free, scan)
        i = heapq.heappop(free)
        if done[i]:
            continue
        done[i] = True
        order.append(i)
        for j in after[i]:
            left[j] -= 1
            if not left[j] and not done[j]:
                heapq.heappush(free, j)
    return [nodes[i] for i in order], counts


def formatted(conv: DataFrame) -> DataFrame:
    """conv_id, n_messages, n_calls, n_linked, n_unanswered, n_orphans, n_invalid, n_cyclic, json: a row a conversation.

    Rows with a null conv_id belong to no conversation and are left out; a null turn comes first, a null role counts as
    'user' and a null text as empty; equal turns are ordered by role, then text, and repeated rows are all kept. The first
    call and the first result of an identifier are linked. Malformed JSON, or JSON of another shape, is plain text. A cycle
    of references is broken at its earliest message. Extra columns are not read; texts of any length are kept whole; an
    empty table gives an empty result.
    """
    m = messages(conv)
    link = links(m).groupBy("conv_id").agg(F.collect_list(F.struct("id", "call_at", "result_at")).alias("linked"))
    whole = m.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("seq", "role", "text"))).alias("turns"))
    rows = whole.join(link, "conv_id", "left").select("conv_id", "turns", "linked")

    def run(b: pa.RecordBatch):
        out, counts = [], {k: [] for k in ("n_messages", *COUNTS)}
        turns, linked = b.column("turns"), b.column("linked")
        flat, bounds = turns.flatten(), np.asarray(turns.offsets)
        bounds = bounds - bounds[0]
        r, x = (flat.field(k).to_pylist() for k in ("role", "text"))
        for k in range(len(turns)):
            a, z = bounds[k], bounds[k + 1]
            ms, c = conversation(list(zip(r[a:z], x[a:z])), [(y["id"], y["call_at"], y["result_at"]) for y in linked[k].as_py() or ()])
            out.append(canonical({"messages": ms}))
            counts["n_messages"].append(len(ms))
            for key in COUNTS:
                counts[key].append(c[key])
        yield pa.record_batch({"conv_id": b.column("conv_id"), **{k: i64(v) for k, v in counts.items()}, "json": pa.array(out, pa.string())})

    return arrow_map(rows, run, "conv_id long, n_messages long, " + ", ".join(f"{k} long" for k in COUNTS) + ", json string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formatted(table(spark, sf_dir, "conversations"))


def with_tools(conv: DataFrame) -> DataFrame:
    """conv with tool turns made from it, as the tables have none: a tool declared in each conversation; for each assistant's turn a
    call, of which some break the schema or name an unknown tool; results of most calls, some of them told before the call; and
    results that answer no call."""
    c = conv.where("conv_id is not null and turn is not null")
    t = F.col("turn").cast("string")
    calls = c.where("role = 'assistant'")
    name = F.when(F.col("turn") % 5 == 4, "other").otherwise("count")
    row = lambda df, turn, role, text: df.select("conv_id", turn.cast("long").alias("turn"), F.lit(role).alias("role"), text.alias("text"))
    call = F.concat(F.lit('{"tool_calls": [{"id": "c'), t, F.lit('", "name": "'), name, F.lit('", "arguments": {"n": '), t, F.lit("}}]}"))
    answer = F.concat(F.lit('{"content": "'), t, F.lit('", "tool_call_id": "c'), t, F.lit('"}'))
    each = c.select("conv_id").distinct()
    return (
        c.select("conv_id", (F.col("turn") * 10).alias("turn"), "role", "text")
        .union(row(each, F.lit(-5), "system", F.lit(TOOLS)))
        .union(row(calls, F.col("turn") * 10 + 5, "assistant", call))
        .union(row(calls.where("turn % 4 <> 3"), F.col("turn") * 10 + F.when(F.col("turn") % 3 == 0, -5).otherwise(6), "tool", answer))
        .union(row(each.where("conv_id % 7 = 0"), F.lit(1_000_000), "tool", F.lit('{"tool_call_id": "none", "content": null}')))
    )


TOOLS = '{"tools": [{"name": "count", "parameters": {"type": "object", "required": ["n"], "properties": {"n": {"minimum": 3, "type": "integer"}}}}]}'


def query_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations with tool turns made from them."""
    return formatted(with_tools(table(spark, sf_dir, "conversations")))


#: For conversations without JSON turns, as the table has them.
SQL = """
SELECT conv_id, count(*) AS n_messages, 0 AS n_calls, 0 AS n_linked, 0 AS n_unanswered, 0 AS n_orphans, 0 AS n_invalid, 0 AS n_cyclic,
       '{"messages":[' || string_agg('{"content":' || to_json(coalesce(text, ''))::VARCHAR || ',"role":' || to_json(coalesce(role, 'user'))::VARCHAR || '}', ','
                                     ORDER BY turn NULLS FIRST, coalesce(role, 'user'), coalesce(text, '')) || ']}' AS json
FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
"""

#: a result that is told before its call comes right after it
SQL_TOOL_CALLS = """
WITH c AS (SELECT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
a AS (SELECT *, turn % 5 <> 4 AND turn >= 3 AS valid, turn % 4 <> 3 AS answered FROM c WHERE role = 'assistant'),
m AS (
  SELECT conv_id, turn * 10.0 AS place, role, '{"content":' || to_json(text)::VARCHAR || ',"role":' || to_json(role)::VARCHAR || '}' AS json FROM c
  UNION ALL SELECT DISTINCT conv_id, -5.0, 'system', '{"content":"","role":"system","tools":[{"name":"count","parameters":{"properties":{"n":{"minimum":3,"type":"integer"}},"required":["n"],"type":"object"}}]}' FROM c
  UNION ALL SELECT conv_id, turn * 10 + 5.0, role, '{"content":"","role":"assistant","tool_calls":[{"arguments":{"n":' || turn || '},"errors":['
                   || CASE WHEN turn % 5 = 4 THEN '"unknown tool"' WHEN turn < 3 THEN '"$.n: below minimum"' ELSE '' END || '],"id":"c' || turn || '","name":"'
                   || CASE WHEN turn % 5 = 4 THEN 'other' ELSE 'count' END || '","valid":' || valid::VARCHAR || '}]}' FROM a
  UNION ALL SELECT conv_id, CASE WHEN turn % 3 = 0 THEN turn * 10 + 5.5 ELSE turn * 10 + 6.0 END, 'tool', '{"content":"' || turn || '","role":"tool","tool_call_id":"c' || turn || '"}' FROM a WHERE answered
  UNION ALL SELECT DISTINCT conv_id, 1000000.0, 'tool', '{"content":"","role":"tool","tool_call_id":"none"}' FROM c WHERE conv_id % 7 = 0),
n AS (SELECT conv_id, count(*) AS n_calls, count(*) FILTER (WHERE answered) AS n_linked, count(*) FILTER (WHERE NOT answered) AS n_unanswered, count(*) FILTER (WHERE NOT valid) AS n_invalid FROM a GROUP BY conv_id)
SELECT m.conv_id, count(*) AS n_messages, coalesce(any_value(n_calls), 0) AS n_calls, coalesce(any_value(n_linked), 0) AS n_linked, coalesce(any_value(n_unanswered), 0) AS n_unanswered,
       (CASE WHEN m.conv_id % 7 = 0 THEN 1 ELSE 0 END)::BIGINT AS n_orphans, coalesce(any_value(n_invalid), 0) AS n_invalid, 0 AS n_cyclic,
       '{"messages":[' || string_agg(json, ',' ORDER BY place, role, json) || ']}' AS json
FROM m LEFT JOIN n ON n.conv_id = m.conv_id GROUP BY m.conv_id
"""
