"""Validated requests over solved tables: the interactive surface."""

from __future__ import annotations

import math
import re
from urllib.parse import parse_qs

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachlab.functions import columns as C
from reachlab.operators import graph as G
from reachlab.operators import trees as T


class RequestError(ValueError):
    """code is a fixed word of the taxonomy; the message never repeats the request."""

    def __init__(self, code: str):
        super().__init__(code)
        self.code = code


def parse_point(query: str, name: str) -> tuple[float, float]:
    """lat, lon of one parameter, which must come exactly once."""
    if len(query) > 2000:
        raise RequestError("too_long")
    values = parse_qs(query, keep_blank_values=True).get(name, [])
    if len(values) != 1:
        raise RequestError("missing" if not values else "repeated")
    m = re.fullmatch(r"(-?\d{1,3}(?:\.\d{1,12})?),(-?\d{1,3}(?:\.\d{1,12})?)", values[0])
    if not m:
        raise RequestError("malformed")
    lat, lon = float(m[1]), float(m[2])
    if not (math.isfinite(lat) and abs(lat) <= 90 and abs(lon) <= 180):
        raise RequestError("out_of_range")
    return lat, lon


class Engine:
    """Answers over a graph; solved trees are kept as tables, the last few of them."""

    def __init__(self, edges: DataFrame, keep: int = 2):
        self.edges, self.keep, self.trees = edges, keep, {}

    def tree(self, source: int) -> DataFrame:
        if source not in self.trees:
            while len(self.trees) >= self.keep:  # room first
                self.trees.pop(next(iter(self.trees))).unpersist()
            start = self.edges.sparkSession.createDataFrame([(source, source)], "origin int, node int")
            self.trees[source] = G.shortest_paths(self.edges, start).persist()
        self.trees[source] = self.trees.pop(source)
        return self.trees[source]

    def solve(self, source: int, target: int) -> DataFrame:
        """node, minutes, path; no row if the target cannot be reached."""
        tree = self.tree(source)
        return T.paths(tree).filter(F.col("node") == target).join(tree.select("origin", "node", F.col("d").alias("minutes")), ["origin", "node"]).select("node", "minutes", "path")

    def map(self, source: int, nodes: DataFrame) -> DataFrame:
        return nodes.join(self.tree(source).select("node", "d"), "node", "left").select("node", C.encode_u16("d").alias("code"))
