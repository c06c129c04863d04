"""Frontmatter block -> tree of metadata (A4), by built-in expressions on the document's row.

The block's lines become tokens (keys, list items, texts); one fold over the
tokens carries a stack of the open keys and items by indentation, finds every
node's parent and rejects blocks in which the children of one parent differ in
kind, or keys in indentation (items of one list may differ in it). Accepted of YAML:

* ``key: value`` at any depth, ``- item`` lists (also at their key's indentation,
  of texts, lists and mappings), quoted keys;
* values on one line, plain values that go on in deeper lines (joined by blanks),
  quoted values, lists in brackets without nested brackets or quotes;
* block scalars ``|`` and ``>`` with ``-`` and ``+``;
* comment lines, and comments behind plain values; a repeated key of one mapping
  keeps its first position and its last value.

Any other block does not parse: a line that is no mapping at the left margin, a
tab in the indentation, children of a value, a plain value with ``: `` in it, a
quotation mark that is not closed on its line. Anchors, tags and mappings in
braces stay texts. In the tree, unquoted numbers, ``true``, ``false``, ``null``,
``~`` and empty values have their type; the flat view keeps them as written.
Time grows with the square of the nodes of one block (3,000 nodes take seconds);
blocks of prose are left before the fold, so their length doesn't count.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import strip_ws

_END = 2147483647
_KEY = r"""^("[^"]*"|'[^']*'|[^\s#:"'\[\]{}&*!|>%@`,?-][^:"']*?)[ \t]*:(?:[ \t]+(.*))?$"""
_QUOTED = r"""^"[^"]*"$|^'[^']*'$"""
_BLOCK = r"^[|>][+-]?$"

_NODE = ("struct<id:int,parent:int,kind:string,key:string,path:string,kinds:array<string>,above:array<int>,"
         "texts:array<string>>")
_STATE = (f"struct<ok:boolean,stack:array<struct<ind:int,id:int,child:string,cind:int,n:int,path:string,"
          f"kinds:array<string>,above:array<int>>>,nodes:array<{_NODE}>,last:{_NODE}>")


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once (subexpressions of lambdas are not shared)."""
    return F.transform(F.array(value), use)[0]


def _unquote(c: Column) -> Column:
    return F.regexp_replace(c, r"""^"([^"]*)"$|^'([^']*)'$""", "$1$2")


def lines(block: Column) -> Column:
    """struct(raw, ind, rest, key, value, dashes) of every line."""
    def first(raw):
        pre = F.regexp_extract(raw, r"^ *(?:-(?: +|$))*", 0)
        return F.struct(raw.alias("raw"), F.length(F.regexp_extract(raw, r"^ *", 0)).alias("ind"), pre.alias("pre"),
                        strip_ws(F.substring(raw, F.length(pre) + 1, F.lit(_END))).alias("rest"))

    def second(l):
        value = strip_ws(F.regexp_extract(l["rest"], _KEY, 2))
        column = F.length(l["pre"])
        dashes = F.filter(F.sequence(F.lit(0), column), lambda i: F.substring(l["pre"], i + 1, F.lit(1)) == "-")
        return F.struct(
            l["raw"], l["ind"], l["rest"], column.alias("column"), dashes.alias("dashes"),
            F.when(l["rest"].rlike(_KEY), _unquote(F.regexp_extract(l["rest"], _KEY, 1))).alias("key"),
            F.when(l["rest"].rlike(_KEY), value).otherwise(l["rest"]).alias("value"))
    return F.transform(F.transform(F.split(F.regexp_replace(block, "\r", ""), "\n", -1), first), second)


def starts_as_mapping(rows: Column) -> Column:
    """False for blocks with a text at the left margin: most blocks that are no metadata, however long."""
    return F.forall(rows, lambda l: (l["ind"] > 0) | (l["rest"] == "") | l["rest"].startswith("#")
                    | l["key"].isNotNull() | (F.size(l["dashes"]) > 0))


def one_value_a_line(tokens_: Column) -> Column:
    """False where a text outside block scalars opens a mapping: known without the fold, as prose blocks can be long."""
    return F.forall(tokens_, lambda t: (t["kind"] != "text") | t["text"].rlike(_QUOTED) | ~t["text"].rlike(r":(\s|$)"))


def _verbatim(rows: Column) -> Column:
    """One character a line: ``v`` for the content of a block scalar, ``n`` for other lines."""
    def step(s, l):
        blank = strip_ws(l["raw"]) == ""
        inside = (s["open"] >= 0) & (blank | (l["ind"] > s["open"]))
        header = l["value"].rlike(_BLOCK) & ~l["rest"].startswith("#")
        column = F.when(l["key"].isNotNull(), l["column"]).otherwise(F.coalesce(F.element_at(
            F.concat(F.array(F.lit(0)), l["dashes"]), -1), F.lit(0)))
        return F.struct(
            F.when(inside, s["open"]).when(blank, s["open"]).when(header, column).otherwise(F.lit(-1)).alias("open"),
            F.concat(s["marks"], F.when(inside, "v").otherwise("n")).alias("marks"))
    zero = F.struct(F.lit(-1).alias("open"), F.lit("").alias("marks"))
    return F.split(F.aggregate(rows, zero, step, lambda s: s["marks"]), "")


def tokens(rows: Column) -> Column:
    """struct(kind, ind, text) in reading order. Keys have even indentations, items the odd one behind them."""
    def token(kind, ind, text):
        return F.struct(F.lit(kind).alias("kind"), ind.cast("int").alias("ind"), text.cast("string").alias("text"))

    def plain(v):
        return F.when(v.rlike(_QUOTED), v).otherwise(F.regexp_replace(v, r"(^|\s+)#.*$", ""))

    def of_line(l, mark):
        none = F.array().cast("array<struct<kind:string,ind:int,text:string>>")
        inner = F.lit(_END)
        items = F.transform(l["dashes"], lambda c: token("item", 2 * c + 1, F.lit(None)))
        value = plain(l["value"])
        text = F.when(value == "", none).otherwise(F.array(token("text", F.when(
            l["key"].isNotNull() | (F.size(l["dashes"]) > 0), inner).otherwise(2 * l["column"]), value)))
        key = F.when(l["key"].isNotNull(), F.array(token("key", 2 * l["column"], l["key"]))).otherwise(none)
        return (F.when(mark == "v", F.array(token("raw", inner, l["raw"])))
                .when((strip_ws(l["raw"]) == "") | l["raw"].rlike(r"^\s*#"), none)
                .when(l["raw"].rlike(r"^ *\t"), F.array(token("tab", inner, F.lit(None))))
                .otherwise(F.concat(items, key, text)))
    return F.flatten(F.zip_with(rows, _verbatim(rows), of_line))


def nodes(tokens_: Column) -> Column:
    """Array of nodes in reading order, null where the block does not parse."""
    def step(s, t):
        def place(st):
            return _let(F.element_at(st, -1), lambda top: grow(st, top))

        def grow(st, top):
            text = t["kind"].isin("text", "raw")
            kind = F.when(text, "text").otherwise(t["kind"])
            fits = F.when(text, (top["id"] == s["last"]["id"]) & (top["id"] > 0) & F.coalesce(
                top["child"] == "text", F.lit(True))).otherwise(
                (t["kind"] != "tab") & F.coalesce((top["child"] == kind) & ((top["cind"] == t["ind"]) | (kind == "item")),
                                                F.lit(True))
                & ((top["id"] > 0) | (t["kind"] == "key")))
            held = F.struct(top["ind"], top["id"], kind.alias("child"), t["ind"].alias("cind"),
                            (top["n"] + 1).alias("n"), top["path"], top["kinds"], top["above"])
            below = F.slice(st, F.lit(1), F.size(st) - 1)
            new_id = s["last"]["id"] + 1
            path = F.concat(top["path"], F.when(kind == "item", F.concat(
                F.lit("["), top["n"].cast("string"), F.lit("]"))).otherwise(F.concat(F.lit('["'), t["text"], F.lit('"]'))))
            kinds, above = F.concat(top["kinds"], F.array(kind)), F.concat(top["above"], F.array(new_id))
            last, none = s["last"], F.array().cast("array<string>")
            more = F.struct(last["id"], last["parent"], last["kind"], last["key"], last["path"], last["kinds"],
                            last["above"], F.concat(last["texts"], F.array(t["text"])).alias("texts"))
            fresh = F.struct(new_id.alias("id"), top["id"].alias("parent"), kind.alias("kind"),
                             F.when(kind == "key", t["text"]).alias("key"), path.alias("path"), kinds.alias("kinds"),
                             above.alias("above"), none.alias("texts"))
            opened = F.struct(t["ind"].alias("ind"), new_id.alias("id"), F.lit(None).cast("string").alias("child"),
                              F.lit(None).cast("int").alias("cind"), F.lit(0).alias("n"), path.alias("path"),
                              kinds.alias("kinds"), above.alias("above"))
            failed = F.lit(None).cast(_STATE)
            texted = F.struct(F.lit(True).alias("ok"), F.concat(below, F.array(held)).alias("stack"),
                              s["nodes"].alias("nodes"), more.alias("last")).cast(_STATE)
            headed = F.struct(F.lit(True).alias("ok"), F.concat(below, F.array(held, opened)).alias("stack"),
                              F.concat(s["nodes"], F.array(last)).alias("nodes"), fresh.alias("last")).cast(_STATE)
            return F.when(~fits, failed).when(text, texted).otherwise(headed)
        return F.when(s.isNotNull(), _let(F.filter(s["stack"], lambda e: e["ind"] < t["ind"]), place))

    zero = F.expr(
        "named_struct('ok', true, 'stack', array(named_struct('ind', -1, 'id', 0, 'child', null, 'cind', null, 'n', 0,"
        " 'path', '$', 'kinds', array(), 'above', array())), 'nodes', array(), 'last', named_struct('id', 0, 'parent', -1,"
        " 'kind', 'root', 'key', null, 'path', '$', 'kinds', array(), 'above', array(), 'texts', array()))").cast(_STATE)
    found = F.aggregate(tokens_, zero, step, lambda s: F.when(s.isNotNull(), F.concat(s["nodes"], F.array(s["last"]))))
    return F.filter(found, lambda n: n["id"] > 0)


def valid_texts(nodes_: Column) -> Column:
    """Whether no value opens a mapping or leaves a quotation mark open."""
    def fine(n):
        head = F.try_element_at(n["texts"], F.lit(1))
        closed = head.rlike(_QUOTED) & (F.size(n["texts"]) == 1)
        return head.isNull() | head.rlike(_BLOCK) | closed | (~head.rlike(r"""^["']""") & F.forall(
            n["texts"], lambda x: ~x.rlike(r":(\s|$)")))
    return F.forall(nodes_, fine)


def last_values(nodes_: Column) -> Column:
    """Without the earlier ones of keys repeated in one mapping, and without what is below them."""
    names = F.transform(F.filter(nodes_, lambda n: n["key"].isNotNull()), lambda n: F.struct(n["parent"], n["key"]))
    dead = F.transform(F.filter(nodes_, lambda n: F.exists(nodes_, lambda m: (m["parent"] == n["parent"])
                                & (m["key"] == n["key"]) & (m["id"] > n["id"]))), lambda n: n["id"])
    kept = _let(dead, lambda d: F.filter(nodes_, lambda n: ~F.arrays_overlap(n["above"], d)))
    return F.when(F.size(F.array_distinct(names)) < F.size(names), kept).otherwise(nodes_)


def _text(n: Column) -> Column:
    """A leaf's text as YAML joins its lines, quotes kept."""
    head = F.try_element_at(n["texts"], F.lit(1))
    rows = F.slice(n["texts"], F.lit(2), F.greatest(F.size(n["texts"]) - 1, F.lit(0)))
    margin = F.length(F.regexp_extract(F.coalesce(F.try_element_at(F.filter(
        rows, lambda r: strip_ws(r) != ""), F.lit(1)), F.lit("")), "^ *", 0))
    whole = _let(margin, lambda m: F.array_join(F.transform(rows, lambda r: F.substring(r, m + 1, F.lit(_END))), "\n"))
    folded = F.regexp_replace(F.regexp_replace(whole, r"(?<!\n)\n(?!\n|$)", " "), r"(?<=[^\n])\n(\n+)(?=[^\n])", "$1")
    body = F.when(head.startswith(">"), folded).otherwise(whole)
    trimmed = F.rtrim(body, F.lit("\n"))
    scalar = (F.when(head.endswith("-") | (trimmed == ""), trimmed).when(head.endswith("+"), F.concat(body, F.lit("\n")))
              .otherwise(F.concat(trimmed, F.lit("\n"))))
    return F.when(head.rlike(_BLOCK), scalar).otherwise(F.array_join(n["texts"], " "))


def _string(c: Column) -> Column:
    """A JSON string literal."""
    whole = F.to_json(F.array(c))
    return F.substring(whole, F.lit(2), F.length(whole) - 2)


def _typed(c: Column) -> Column:
    """A JSON scalar of an unquoted one-line value."""
    return (F.when(c.isin("", "~", "null"), F.lit("null")).when(c.isin("true", "false"), c)
            .when(c.rlike(r"^-?(0|[1-9][0-9]{0,17})(\.[0-9]{1,18})?$"), c).otherwise(_string(_unquote(c))))


def pieces(nodes_: Column) -> Column:
    """struct(top, depth, key, lead, body, text, leaf, path) of every node; leads and bodies joined are the JSON object's content."""
    def texted(n):
        return F.struct(n.alias("n"), F.size(n["kinds"]).alias("depth"), _text(n).alias("text"),
                        F.try_element_at(n["texts"], F.lit(1)).rlike(_BLOCK).alias("block"))

    def piece(all_, p, i):
        nxt = F.try_element_at(all_, i + 2)
        prev = F.when(i > 0, F.element_at(all_, F.when(i > 0, i).otherwise(1)))
        n, depth = p["n"], p["depth"]
        leaf = nxt.isNull() | (nxt["depth"] <= depth)
        lead = F.concat(F.when(F.coalesce(prev["depth"] >= depth, F.lit(False)), ",").otherwise(""),
                        F.when(n["kind"] == "key", F.concat(_string(n["key"]), F.lit(":"))).otherwise(""))
        listed = p["text"].rlike(r"""^\[[^\[\]{}"']*\]$""")
        members = F.split(F.regexp_replace(p["text"], r"^\[\s*|\s*,?\s*\]$", ""), r"\s*,\s*", -1)
        scalar = (F.when(F.coalesce(p["block"], F.lit(False)), _string(p["text"]))
                  .when(listed, F.concat(F.lit("["), F.when(p["text"].rlike(r"^\[\s*\]$"), "").otherwise(
                      F.array_join(F.transform(members, _typed), ",")), F.lit("]")))
                  .otherwise(_typed(p["text"])))
        stop = F.greatest(F.coalesce(nxt["depth"], F.lit(1)), F.lit(1))
        closers = F.array_join(F.reverse(F.transform(
            F.slice(n["kinds"], stop + 1, F.greatest(depth - stop, F.lit(0))),
            lambda k: F.when(k == "item", "]").otherwise("}"))), "")
        body = F.when(leaf, F.concat(scalar, closers)).otherwise(F.when(nxt["n"]["kind"] == "item", "[").otherwise("{"))
        return F.struct(n["above"][0].alias("top"), depth.alias("depth"), n["key"].alias("key"), lead.alias("lead"),
                        body.alias("body"), p["text"].alias("text"), leaf.alias("leaf"), n["path"].alias("path"),
                        n["kind"].alias("kind"))
    return _let(F.transform(nodes_, texted), lambda all_: F.transform(all_, lambda p, i: piece(all_, p, i)))


def tree(pieces_: Column) -> Column:
    """The metadata as VARIANT."""
    return F.try_parse_json(F.concat(F.lit("{"), F.array_join(F.transform(
        pieces_, lambda p: F.concat(p["lead"], p["body"])), ""), F.lit("}")))


def flat(pieces_: Column, first_keys: Column) -> Column:
    """(key, value) of the outermost keys: texts as written without quotes, lists of texts as ``[a, b]``, other values as JSON."""
    def value(k):
        mine = F.filter(pieces_, lambda p: p["top"] == k["top"])

        def shown(m):
            inner = F.slice(m, F.lit(2), F.greatest(F.size(m) - 1, F.lit(0)))
            texts = F.transform(inner, lambda p: _unquote(p["text"]))
            json = F.concat(m[0]["body"], F.array_join(F.transform(inner, lambda p: F.concat(p["lead"], p["body"])), ""))
            plain = F.forall(inner, lambda p: p["leaf"] & (p["kind"] == "item"))
            return (F.when(m[0]["leaf"], _unquote(m[0]["text"]))
                    .when(plain, F.concat(F.lit("["), F.array_join(texts, ", "), F.lit("]"))).otherwise(json))
        return _let(mine, shown)
    tops = F.filter(pieces_, lambda p: p["depth"] == 1)
    return _let(tops, lambda ts: F.transform(first_keys, lambda name: _let(F.filter(
        ts, lambda p: p["key"] == name)[0], lambda k: F.struct(name.alias("key"), value(k).alias("value")))))


def leaves(pieces_: Column) -> Column:
    """struct(path, text) of every value without children; the path is one that ``variant_get`` takes."""
    return F.transform(F.filter(pieces_, lambda p: p["leaf"]), lambda p: F.struct(p["path"], _unquote(p["text"]).alias("text")))
