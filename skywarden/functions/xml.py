"""XML helpers (B18, B20): plain paths in one reading of a page, others by
Spark's XPath functions.

Spark's ``xpath*`` functions need a literal path and read the text again for
every path, so paths are Python strings here (rule tables are small and read
before the plan is built).
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .parsing import last_wins_map


def _c(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def node_text(path: str) -> str:
    """XPath of the text of the nodes matched by ``path`` (Spark's
    ``xpath`` yields NULL for element nodes themselves)."""
    p = path.rstrip("/")
    return p if p.endswith("text()") or "(" in p.rsplit("/", 1)[-1] else p + "/text()"


# Element put around a text to see what stands beside its root.
_AROUND = "around-page"


def page_text(body) -> Column:
    """The body from its first ``<page>`` on, or NULL unless that is one
    well-formed ``page`` element with nothing but white space after it.

    The ``xpath*`` functions fail the job on malformed text; the tolerant
    XML reader tells beforehand.  What follows the root it overlooks, so
    it reads the text inside another element, whose pages are counted.
    """
    at = F.instr(_c(body), "<page>")
    text = F.substring(_c(body), at, F.length(_c(body)))
    whole = (at > 0) & text.rlike(r"</page\s*>\s*\z") & ~text.contains(f"</{_AROUND}")
    around = F.concat(F.lit(f"<{_AROUND}>"), text, F.lit(f"</{_AROUND}>"))
    read = F.from_xml(around, "bad string, page string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"})
    pages = F.xpath_int(around, F.lit(f"count(/{_AROUND}/page)"))
    return F.when(whole & read["bad"].isNull(), F.when(pages == 1, text))


# Element names from the root down, or one name at any depth, and perhaps their text nodes.
_PLAIN = re.compile(r"(?:(?://[A-Za-z_][\w.-]*)|(?:/[A-Za-z_][\w.-]*)+)(?:/text\(\))?", re.ASCII)


def _page_reader(lists: list[str], firsts: list[str]):
    """Function from arrays of bodies to structs with the values of plain paths."""
    around, closed = f"</{_AROUND}", re.compile(r"</page\s*>\s*\Z", re.ASCII)
    paths = [(p, True) for p in lists] + [(p, False) for p in firsts]
    # A step leads to (further steps, slots at this place); a name at any depth has slots only.
    top, anywhere = ({}, []), {}
    for slot, (path, _) in enumerate(paths):
        steps = path.removesuffix("/text()")
        if steps.startswith("//"):
            anywhere.setdefault(steps[2:], []).append(slot)
            continue
        at = top
        for name in steps[1:].split("/"):
            at = at[0].setdefault(name, ({}, []))
        at[1].append(slot)
    # The value of an element takes in the text of its descendants; all else is made of text nodes.
    whole = {i for i, (p, many) in enumerate(paths) if not many and not p.endswith("/text()")}

    def read(body: str) -> list | None:
        from xml.parsers import expat

        start = body.find("<page>")
        text = body[start:]
        if start < 0 or around in text or not closed.search(text):
            return None
        found, node, cut = [[] for _ in paths], None, False
        stack, places, catching = [top], [[]], []

        def opened(name, attributes):
            nonlocal node
            node = None
            # As in Spark's functions a prefix is overlooked, but for an element named at any depth.
            local = name.partition(":")[2] or name
            inner = stack[-1] and stack[-1][0].get(local)
            stack.append(inner)
            slots = (inner[1] if inner else []) + [s for s in anywhere.get(local, []) if local == name or s not in whole]
            places.append([s for s in slots if s not in whole])
            for s in slots:
                if s in whole and not found[s]:
                    found[s].append([])
                    catching.append((len(stack), found[s][0]))

        def closing(name):
            nonlocal node
            node = None
            while catching and catching[-1][0] == len(stack):
                catching.pop()
            stack.pop()
            places.pop()

        def piece(data):
            # A text node is a row of pieces, one for each CDATA section and each text between.
            nonlocal node, cut
            for _, texts in catching:
                texts.append(data)
            if not places[-1]:
                return
            if node is None:
                node = [data]
                for s in places[-1]:
                    found[s].append(node)
            elif cut:
                node.append(data)
            else:
                node[-1] += data
            cut = False

        def section():
            nonlocal cut
            cut = True
            piece("")

        def section_end():
            nonlocal cut
            cut = True

        def apart(*_):
            nonlocal node
            node = None

        parser = expat.ParserCreate()
        parser.buffer_text = True
        parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = opened, closing, piece
        parser.StartCdataSectionHandler, parser.EndCdataSectionHandler = section, section_end
        parser.CommentHandler = parser.ProcessingInstructionHandler = apart
        try:
            parser.Parse(text, True)
        except expat.ExpatError:
            return None
        # Of a text node in a list Spark's xpath gives the first piece, xpath_string gives all.
        return [[n[0] for n in f] if many else "".join(f[0]) if f else "" for f, (_, many) in zip(found, paths)]

    def run(bodies: pa.Array) -> pa.Array:
        rows = [None if b is None else read(b) for b in bodies.to_pylist()]
        columns = [pa.array([r and r[i] for r in rows], pa.list_(pa.string()) if many else pa.string())
                   for i, (_, many) in enumerate(paths)]
        return pa.StructArray.from_arrays(columns, [f"v{i}" for i in range(len(paths))],
                                          mask=pa.array([r is None for r in rows], pa.bool_()))
    return run


def page_values(body, lists: dict[str, str] | None = None, firsts: dict[str, str] | None = None) -> Column:
    """Struct of the values of XPaths in the page of a body, NULL where
    :func:`page_text` finds none.

    ``lists`` gives the texts of all nodes of a path, ``firsts`` the text of
    the first one (``""`` if there is none).  Plain paths are read together
    in one pass; other paths go through Spark's ``xpath*`` functions.
    """
    lists = {k: node_text(p) for k, p in (lists or {}).items()}
    firsts = firsts or {}
    many = [k for k, p in lists.items() if _PLAIN.fullmatch(p)]
    one = [k for k, p in firsts.items() if _PLAIN.fullmatch(p)]
    found, values = None, {}
    if many or one:
        kinds = ["array<string>"] * len(many) + ["string"] * len(one)
        reader = F.arrow_udf(_page_reader([lists[k] for k in many], [firsts[k] for k in one]),
                             f"struct<{', '.join(f'v{i}: {kind}' for i, kind in enumerate(kinds))}>")
        found = reader(_c(body))
        values = {k: found[f"v{i}"] for i, k in enumerate([*many, *one])}
    others = {**{k: F.xpath for k in lists if k not in many}, **{k: F.xpath_string for k in firsts if k not in one}}
    if others or found is None:
        page = page_text(body)
        values |= {k: f(page, F.lit(lists[k] if f is F.xpath else firsts[k])) for k, f in others.items()}
    there = (page if found is None else found).isNotNull()
    return F.when(there, F.struct(*[values[k].alias(k) for k in [*lists, *firsts]]))


def xml_flat_map(xml, paths: dict[str, str]) -> Column:
    """``key + index -> value`` over several multi-node XPaths.

    Every node matched by ``paths[key]`` becomes one entry ``key<i>`` with
    ``i`` counting from 0 in document order; of equal keys (node 10 of
    ``n`` and node 0 of ``n1``) the last path wins.  A body without one
    well-formed page gives an empty map.
    """
    none = F.array().cast("array<struct<k:string,v:string>>")
    if not paths:
        return last_wins_map(none)
    page = page_values(xml, lists=paths)

    def entries_of(key: str) -> Column:
        return F.transform(page[key], lambda v, i: F.struct(
            F.concat(F.lit(key), i.cast("string")).alias("k"), v.alias("v")))

    return last_wins_map(F.coalesce(F.flatten(F.array(*[entries_of(k) for k in paths])), none))


# Segment type codes of a booking XML.
SEGTYPE_TRAVEL = {"S": "OneWay", "R": "RoundTrip"}


def segtype_travel(xml, path: str = "//SEGTYPE") -> Column:
    """Segment type S / R -> OneWay / RoundTrip, else Unknown.

    Read from the first ``<page>`` to the first ``</page>``, whatever
    stands around them; no page or a malformed one is Unknown.
    """
    end = F.instr(_c(xml), "</page>")
    page = F.substring(_c(xml), F.lit(1), end + F.lit(len("</page>") - 1))
    seg = page_values(page, firsts={"seg": node_text(path)})["seg"]
    out = F.lit("Unknown")
    for code, name in reversed(list(SEGTYPE_TRAVEL.items())):
        out = F.when(seg == code, F.lit(name)).otherwise(out)
    return out
