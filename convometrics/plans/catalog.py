"""All registered queries and their oracle SQL, by name."""

from __future__ import annotations

from . import corpus_queries, dialog_queries, eval_queries, ops_queries, run_queries


def all_queries():
    out = {}
    for mod in (eval_queries, corpus_queries, dialog_queries, ops_queries, run_queries):
        out.update(mod.QUERIES)
    return out


def all_oracles():
    out = {}
    for mod in (eval_queries, corpus_queries, dialog_queries, ops_queries, run_queries):
        out.update(mod.ORACLES)
    return out
