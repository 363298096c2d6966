"""Physical plans that ran: node counts per registered query.

``counts`` reads the executed plan of a DataFrame that has been collected, so
adaptive decisions are in it. ``tools/check_oracle.py`` calls it for every
query it runs when PLANS=1 is set, and writes PLANS.md.
"""

from __future__ import annotations

import os
import re

COLUMNS = ["shuffles", "broadcasts", "sort-merge joins", "split by skew", "broadcast joins", "Python nodes",
           "group limits", "partial aggs", "file scans", "scans reading html", "checkpoint scans"]


def executed(df) -> str:
    """The final plan of a collected DataFrame (the initial plan left out)."""
    text = df._jdf.queryExecution().executedPlan().toString()
    if "AdaptiveSparkPlan" in text and "isFinalPlan=true" not in text:
        raise ValueError("the DataFrame was not run")
    return re.sub(r"== Initial Plan ==.*", "", text, flags=re.S)


def counts(df) -> list[int]:
    p = executed(df)
    n = lambda pattern: len(re.findall(pattern, p))
    scans = re.findall(r"FileScan .*", p)
    return [n(r"\bExchange (?:hash|range|single|RoundRobin)"), n(r"\bBroadcastExchange\b"), n(r"\bSortMergeJoin\b"),
            n(r"skew=true"), n(r"\bBroadcastHashJoin\b"), n(r"\b(?:ArrowEvalPython|MapInPandas|MapInArrow|BatchEvalPython)\b"),
            n(r"\bWindowGroupLimit\b"), n(r"functions=\[partial_"), len(scans),
            sum("html:string" in s for s in scans), n(r"Scan ExistingRDD")]


def write(rows: list[tuple[str, list[int]]], sf: str) -> None:
    out = ["# PLANS", "",
           f"Node counts of the plans that ran, per registered query at `{sf}` (`PLANS=1 python tools/check_oracle.py`).",
           "They are read from the collected DataFrame after adaptive execution. Jobs before the last one (BFS levels,",
           "checkpoints, written tables) are not counted; what they wrote appears as scans.", "",
           "| query | " + " | ".join(COLUMNS) + " |", "|---" * (len(COLUMNS) + 1) + "|"]
    out += [f"| {k} | " + " | ".join(map(str, r)) + " |" for k, r in rows]
    out += ["", "Broadcasts are adaptive execution's, from measured sizes, but for the query weights of the search, which are",
            "broadcast in slices of a fixed number of rows.", ""]
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    with open(os.path.join(root, "PLANS.md"), "w") as f:
        f.write("\n".join(out))
