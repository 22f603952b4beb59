"""Tag soup: the only Python that runs inside tasks.

A small reader lists block elements with the cell elements below them; all rules about which
blocks and cells matter are column expressions elsewhere. The module is pickled by value, so
executors need no installed copy.
"""

from __future__ import annotations

import re
import sys
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
HIDDEN = {"script", "style", "template"}
#: Names of tags that the parser itself treats as any other.
_BARE_START = re.compile(r"<(td|tr|th|li|ul|ol|b|i|p|div|span|table|tbody|thead|body|head|html)>")
_BARE_END = re.compile(r"</(td|tr|th|li|ul|ol|b|i|p|div|span|table|tbody|thead|body|head|html)>")


class BlockReader(HTMLParser):
    """Every block element with the cell elements below it, as classes and joined text."""

    def __init__(self, block: str, cells: tuple[str, ...]):
        super().__init__()
        self.block, self.cells = block, frozenset(cells)
        self.blocks: list[dict] = []
        self.open: list[tuple] = []
        self.unnamed = 0

    def updatepos(self, i, j):
        return j  # nobody asks for line numbers

    def parse_starttag(self, i):
        bare = _BARE_START.match(self.rawdata, i)
        if bare is None:
            return super().parse_starttag(i)
        self.handle_starttag(bare[1], ())
        return bare.end()

    def parse_endtag(self, i):
        bare = None if self.cdata_elem else _BARE_END.match(self.rawdata, i)
        if bare is None:
            return super().parse_endtag(i)
        self.handle_endtag(bare[1])
        return bare.end()

    def handle_starttag(self, tag, attrs):
        attrs, entry = dict(attrs), None
        if tag == self.block:
            name = attrs.get("id")
            if not name:
                name, self.unnamed = f"_misc{self.unnamed}", self.unnamed + 1
            entry = {"name": name, "cells": []}
            self.blocks.append(entry)
        elif tag in self.cells:
            entry = {"classes": (attrs.get("class") or "").split(), "text": []}
            for open_tag, outer in self.open:
                if open_tag == self.block:
                    outer["cells"].append(entry)
        if tag not in VOID:
            self.open.append((tag, entry))

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] == tag:
                del self.open[depth:]
                return

    def handle_data(self, data):
        text = data.strip()
        if text and not any(tag in HIDDEN for tag, _ in self.open):
            for tag, entry in self.open:
                if tag in self.cells:
                    entry["text"].append(text)


class LinkReader(HTMLParser):
    def __init__(self):
        super().__init__()
        self.links: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.links.extend(value or "" for name, value in attrs if name == "href")


def read_blocks(html: str | None, block: str, cells: tuple[str, ...]) -> list[dict]:
    reader = BlockReader(block, cells)
    reader.feed(html or "")
    reader.close()
    return [{"name": b["name"],
             "cells": [{"classes": c["classes"], "text": " ".join(c["text"])}
                       for c in b["cells"]]} for b in reader.blocks]


def read_links(html: str | None) -> list[str]:
    reader = LinkReader()
    reader.feed(html or "")
    reader.close()
    return reader.links


def page_blocks(html: Column, block: str, cells: tuple[str, ...]) -> Column:
    """Blocks of a page as array<struct<name, cells: array<struct<classes, text>>>>."""
    def blocks(pages: pa.Array) -> pa.Array:
        names, texts, classes = [], [], []
        of_page, of_block, of_cell = [0], [0], [0]  # where the blocks of a page end, the cells of a block, ...
        for page in pages.to_pylist():
            for found in read_blocks(page, block, cells):
                names.append(found["name"])
                for cell in found["cells"]:
                    texts.append(cell["text"])
                    classes.extend(cell["classes"])
                    of_cell.append(len(classes))
                of_block.append(len(texts))
            of_page.append(len(names))
        nested = lambda ends, values: pa.ListArray.from_arrays(
            pa.array(ends, pa.int32()), values, pa.list_(pa.field("element", values.type)))
        cell = pa.StructArray.from_arrays([nested(of_cell, pa.array(classes, pa.string())), pa.array(texts, pa.string())],
                                          ["classes", "text"])
        return nested(of_page, pa.StructArray.from_arrays([pa.array(names, pa.string()), nested(of_block, cell)],
                                                          ["name", "cells"]))

    kind = "array<struct<name: string, cells: array<struct<classes: array<string>, text: string>>>>"
    # not deterministic in name only: a filter on what is read would otherwise read every page a second time
    return F.arrow_udf(blocks, kind).asNondeterministic()(html)


def anchor_hrefs(html: Column) -> Column:
    """Values of all anchor links of a page, entities resolved."""
    def hrefs(pages: pd.Series) -> pd.Series:
        return pages.map(read_links)

    return F.pandas_udf(hrefs, "array<string>")(html)
