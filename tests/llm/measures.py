"""Held-out accuracy of a scored table."""

from __future__ import annotations


def accuracy(scored, labels, label):
    rows = scored.where("held_out").join(labels.where(f"{label} IS NOT NULL"), "doc_id").select("predicted", label).collect()
    return sum(r[0] == r[1] for r in rows) / len(rows)
