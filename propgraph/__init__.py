"""Property-graph analytics on Spark DataFrames."""

from propgraph.graph import PropertyGraph, edge_table, vertex_table
from propgraph.operators.match import Node, Rel, match

__all__ = ["Node", "PropertyGraph", "Rel", "edge_table", "match", "vertex_table"]
