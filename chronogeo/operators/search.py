"""Full-text search: a small query language over two text columns.

Terms are joined by AND unless OR or NOT stands between them; "a phrase" matches consecutive words, pre* matches beginnings,
^term the first words of a column, column: or {two columns}: restrict a term or a phrase to columns (-column: to the others),
NEAR(one two, n) matches terms with at most n words between the first and the last, and parentheses group.  AND binds closer
than OR, NOT closest.

Without an index a query becomes one Catalyst predicate over padded, normalised text, and the table is scanned.  With one (see
index_of and write_index) any query is answered by found(): the index, sorted by token, is read for the query's tokens alone,
phrases are put together from positions, and only rows that match are read from the table.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import fold, fold_of

_LEX = re.compile(r'\s*(?:(?P<quote>"[^"]*")|(?P<mark>[():*^{},])|(?P<word>[^\s():*"^{},]+))')


class Syntax(ValueError):
    """The query cannot be read."""


def lex(query: str) -> list[tuple[str, str]]:
    out, at = [], 0
    query = query.rstrip()
    while at < len(query):
        m = _LEX.match(query, at)
        if not m:
            raise Syntax(f"unreadable at {at}: {query[at:at + 20]!r}")
        out.append((m.lastgroup, m[m.lastgroup]))
        at = m.end()
    # a comma counts inside NEAR( ) alone; elsewhere it parts words as a space does
    kept, inside = [], False
    for k, t in enumerate(out):
        inside = t != ("mark", ")") and (inside or (t == ("mark", "(") and k > 0 and out[k - 1] == ("word", "NEAR")))
        if inside or t != ("mark", ","):
            kept.append(t)
    return kept


def parse(query: str):
    """('and'|'or'|'not', left, right), ('phrase', words, is_prefix, columns, is_first) or ('near', phrases, words between).

    columns: None, or (names, whether all others are meant).
    """
    toks = lex(query)
    if not toks:
        raise Syntax("empty query")

    def peek(k: int = 0):
        return toks[k] if k < len(toks) else ("end", "")

    def either():
        left = both()
        while peek() == ("word", "OR"):
            toks.pop(0)
            left = ("or", left, both())
        return left

    def both():
        left = without()
        while peek()[0] != "end" and peek() not in (("mark", ")"), ("word", "OR")):
            if peek() == ("word", "AND"):
                toks.pop(0)
            left = ("and", left, without())
        return left

    def without():
        left = atom()
        while peek() == ("word", "NOT"):
            toks.pop(0)
            left = ("not", left, atom())
        return left

    def atom():
        kind, text = peek()
        if (kind, text) == ("mark", "("):
            toks.pop(0)
            inner = either()
            if peek() != ("mark", ")"):
                raise Syntax("a parenthesis is not closed")
            toks.pop(0)
            return inner
        only = columns_of()
        return near(only) if peek() == ("word", "NEAR") and peek(1) == ("mark", "(") else phrase(only)

    def columns_of():
        """The columns that a term is restricted to, if it is."""
        kind, text = peek()
        others = (kind, text) == ("word", "-")
        k = int(others)
        if peek(k) == ("mark", "{"):
            names, k = [], k + 1
            while peek(k)[0] == "word":
                names.append(peek(k)[1].lower())
                k += 1
            if peek(k) != ("mark", "}") or peek(k + 1) != ("mark", ":") or not names:
                raise Syntax("columns are not closed")
            k += 2
        elif kind == "word" and peek(1) == ("mark", ":"):
            others = text.startswith("-")
            names, k = [text.lstrip("-").lower()], 2
        else:
            return None
        del toks[:k]
        if peek()[0] not in ("word", "quote") and peek() != ("mark", "^"):
            raise Syntax("no term after the column")
        return tuple(names), others

    def phrase(only):
        initial = peek() == ("mark", "^")
        if initial:
            toks.pop(0)
        kind, text = peek()
        if kind not in ("word", "quote") or kind == "word" and text in ("AND", "OR", "NOT"):
            raise Syntax(f"no term at {text or 'the end'!r}")
        toks.pop(0)
        terms = re.findall(r"[^\W_]+", fold_of(text))
        if not terms:
            raise Syntax(f"no word in {text!r}")
        prefix = peek() == ("mark", "*")
        if prefix:
            toks.pop(0)
        return ("phrase", tuple(terms), prefix, only, initial)

    def near(only):
        del toks[:2]
        inner, most = [], 10
        while peek() not in (("mark", ")"), ("mark", ","), ("end", "")):
            inner.append(phrase(only))
        if peek() == ("mark", ","):
            kind, text = peek(1)
            if kind != "word" or not text.isascii() or not text.isdigit():
                raise Syntax("NEAR wants a number")
            most = int(text)
            del toks[:2]
        if peek() != ("mark", ")") or not inner:
            raise Syntax("NEAR is not closed, or is empty")
        toks.pop(0)
        return ("near", tuple(inner), most)

    tree = either()
    if toks:
        raise Syntax(f"nothing to join at {toks[0][1]!r}")
    return tree


def normalised(c: Column) -> Column:
    """Words in lower case without diacritics, one space around each. Only texts beyond ASCII leave the JVM."""
    plain = F.coalesce(c, F.lit(""))
    low = F.when(plain.rlike(r"[^\x00-\x7F]"), fold(F.when(plain.rlike(r"[^\x00-\x7F]"), plain))).otherwise(F.lower(plain))
    return F.concat(F.lit(" "), F.regexp_replace(low, r"[^\p{L}\p{N}]+", " "), F.lit(" "))


def _within(only, names) -> list[str]:
    """The columns that a phrase looks at."""
    if only is None:
        return list(names)
    chosen, others = only
    for c in chosen:
        if c not in names:
            raise Syntax(f"no such column: {c}")
    return [n for n in names if (n in chosen) != others]


def _places(text: Column, terms: tuple[str, ...], prefix: bool, initial: bool) -> Column:
    """The positions of words at which a phrase begins in padded text."""
    w = F.split(F.trim(text), " ")
    at = F.sequence(F.lit(0), F.size(w) - 1)

    def here(k: Column) -> Column:
        out = (k == 0) if initial else F.lit(True)
        for i, t in enumerate(terms):
            word = F.coalesce(F.get(w, k + i), F.lit(""))
            out = out & (word.startswith(t) if prefix and i == len(terms) - 1 else word == t)
        return out

    return F.filter(at, here)


def _clump(places: list[Column], reaches: list[int], close) -> Column:
    """Some phrase's place is within its reach of a place of every other one; close(other place, place, reach)."""

    def first(i: int):
        def whole(k: Column) -> Column:
            ok = F.lit(True)
            for j, other in enumerate(places):
                if j != i:
                    ok = ok & F.exists(other, lambda x: close(x, k, reaches[i]))
            return ok

        return whole

    out = F.lit(False)
    for i, p in enumerate(places):
        out = out | F.exists(p, first(i))
    return out


def predicate(tree, columns: dict[str, Column]) -> Column:
    """columns: normalised text by name."""
    kind = tree[0]
    if kind == "phrase":
        _, terms, prefix, only, initial = tree
        needle = " " + " ".join(terms) + ("" if prefix else " ")
        out = F.lit(False)
        for n in _within(only, columns):
            out = out | (columns[n].startswith(needle) if initial else columns[n].contains(needle))
        return out
    if kind == "near":
        _, phrases, most = tree
        out = F.lit(False)
        for n in _within(phrases[0][3], columns):
            have = F.lit(True)
            for p in phrases:  # a cheap check before words are counted
                have = have & predicate((*p[:3], ((n,), False), p[4]), columns)
            places = [_places(columns[n], p[1], p[2], p[4]) for p in phrases]
            out = out | (have & _clump(places, [len(p[1]) + most for p in phrases], lambda x, k, reach: (x >= k) & (x <= k + reach)))
        return out
    a, b = predicate(tree[1], columns), predicate(tree[2], columns)
    return a & b if kind == "and" else a | b if kind == "or" else a & ~b


def matching(df: DataFrame, query: str, columns: tuple[str, ...] = ("title", "blurb")) -> DataFrame:
    tree = parse(query)
    names = {c: f"_text_{c}" for c in columns}
    d = df.withColumns({v: normalised(F.col(k)) for k, v in names.items()})
    return d.where(predicate(tree, {k: F.col(v) for k, v in names.items()})).drop(*names.values())


def search(events: DataFrame, query: str, limit: int = 25) -> DataFrame:
    """The most notable matches; ties by date, then id. The limit is held to 1..100."""
    rows = matching(events, query)
    return rows.orderBy(F.desc_nulls_last("notability"), F.asc_nulls_first("date_start"), "id").limit(min(100, max(1, limit)))


def index_of(df: DataFrame, key: str, columns: tuple[str, ...]) -> DataFrame:
    """(token, id, field, pos): the inverted index."""
    parts = [df.select(F.col(key).alias("id"), F.lit(c).alias("field"), F.posexplode(F.split(F.trim(normalised(F.col(c))), " ")).alias("pos", "token")) for c in columns]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where("token <> ''").select("token", "id", "field", "pos")


#: rows of the index that a task sorts, about
FILE_ROWS = 1_000_000


def in_ranges(index: DataFrame, files: int | None = None) -> DataFrame:
    """The index in ranges of tokens, so many that their size does not grow with it. Ids part the rows of a token that fills more than a
    range: by the token alone the commonest one would be a single task."""
    return index.repartitionByRange(files or max(8, -(-index.count() // FILE_ROWS)), "token", "id")


def write_index(index: DataFrame, path: str, files: int | None = None) -> None:
    """The index as Parquet, in ranges of tokens and sorted, so that a lookup reads the row groups of its tokens."""
    in_ranges(index, files).sortWithinPartitions("token").write.mode("overwrite").parquet(path)


def _leaves(tree) -> list:
    if tree[0] == "phrase":
        return [tree]
    return list(tree[1]) if tree[0] == "near" else _leaves(tree[1]) + _leaves(tree[2])


#: hits of a query that a task gathers, about
HITS = 500_000


def found(index: DataFrame, query: str, columns: tuple[str, ...] = ("title", "blurb"), key: str = "id") -> DataFrame:
    """The ids that match, by the index alone: one read of the query's tokens, and two aggregations by id.

    Hits are counted and sent to so many tasks that none gets more with a larger index: an exchange without a number would be coalesced
    by its bytes, and hits take few of these, but much memory where they are gathered.
    """
    tree = parse(query)
    leaves = _leaves(tree)
    # every (phrase, place in it) that a token can be at
    spots = []
    for i, (_, terms, prefix, only, initial) in enumerate(leaves):
        fields = _within(only, columns)
        for k, t in enumerate(terms):
            last = prefix and k == len(terms) - 1
            hit = (F.col("token").startswith(t) if last else F.col("token") == t) & F.col("field").isin(*fields)
            hit = hit & (F.col("pos") == k) if initial else hit
            spots.append((hit, F.struct(F.lit(i).alias("leaf"), (F.col("pos") - k).alias("start"), F.lit(k).alias("k"))))
    any_hit = spots[0][0]
    for hit, _ in spots[1:]:
        any_hit = any_hit | hit
    hits = index.where(any_hit)
    tasks = max(int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-hits.count() // HITS))
    rows = hits.repartition(tasks, key).select(key, "field", F.explode(F.filter(F.array(*[F.when(hit, spot) for hit, spot in spots]), lambda x: x.isNotNull())).alias("s"))
    size = F.get(F.array(*[F.lit(len(x[1])) for x in leaves]), F.col("leaf"))
    whole = rows.select(key, "field", "s.*").groupBy(key, "field", "leaf", "start").agg(F.count_distinct("k").alias("n")).where(F.col("n") == size)
    place = F.struct("field", "start")
    each = whole.groupBy(key).agg(*[F.collect_list(F.when(F.col("leaf") == i, place)).alias(f"at{i}") for i in range(len(leaves))])
    number = iter(range(len(leaves)))

    def holds(t) -> Column:
        if t[0] == "phrase":
            return F.size(F.col(f"at{next(number)}")) > 0
        if t[0] == "near":
            mine = [F.col(f"at{next(number)}") for _ in t[1]]
            return _clump(mine, [len(p[1]) + t[2] for p in t[1]], lambda y, x, reach: (y["field"] == x["field"]) & (y["start"] >= x["start"]) & (y["start"] <= x["start"] + reach))
        a, b = holds(t[1]), holds(t[2])
        return a & b if t[0] == "and" else a | b if t[0] == "or" else a & ~b

    return each.where(holds(tree)).select(key)


def search_by(index: DataFrame, events: DataFrame, query: str, limit: int = 25) -> DataFrame:
    """search(), with the ids from the index."""
    rows = events.join(found(index, query).hint("shuffle_hash"), "id", "left_semi")  # the ids alone are held, and no event is sorted
    return rows.orderBy(F.desc_nulls_last("notability"), F.asc_nulls_first("date_start"), "id").limit(min(100, max(1, limit)))


def by_index(index: DataFrame, terms: list[str], key: str = "id") -> DataFrame:
    """Ids that have all terms, by the index alone."""
    want = [fold_of(t) for t in dict.fromkeys(terms)]
    return index.where(F.col("token").isin(*want)).groupBy(key).agg(F.count_distinct("token").alias("n")).where(F.col("n") == len(set(want))).select(key)
