"""Constant lookup maps inside a plan."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, functions as F


def constant_map(entries: Mapping, value_type: str) -> Column:
    """A map from text to ``value_type`` that the optimizer folds into one literal.

    Written as one JSON literal: a tree of thousands of small literals would be slow to plan.
    """
    return F.from_json(F.lit(json.dumps(dict(entries))), f"map<string,{value_type}>")
