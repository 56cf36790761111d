"""All registered queries by name."""

from __future__ import annotations

from tariffloom.plans import checks, guests, pipeline, prices, rules, scans

QUERIES = {
    **scans.QUERIES, **guests.QUERIES, **rules.QUERIES, **prices.QUERIES, **pipeline.QUERIES, **checks.QUERIES,
}
