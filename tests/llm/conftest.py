from __future__ import annotations

import pytest

from tideline.llm import common


#: Columns whose names operators use themselves.
CLASHING = ["keep_id", "id", "h", "h_", "sha_", "fp", "n", "gone", "lost_id", "lost_sha", "hit_id", "hit_h", "hit_lines", "every_", "node", "line", "start_", "total_", "bucket_", "class_id", "clean_text"]


@pytest.fixture(params=["broadcast", "shuffle"])
def joins(request, monkeypatch):
    """Both ways of joining: with a broadcast side, and with the side too large for it."""
    if request.param == "shuffle":
        monkeypatch.setattr(common, "BROADCAST_ROWS", -1)


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from texts: ids count up, unless (id, text) are given; with columns of clashing names."""

    def make(texts: list, **more: list):
        rows = [(t if isinstance(t, tuple) else (i, t)) + tuple(v[i] for v in more.values()) + ("clash",) * len(CLASHING) for i, t in enumerate(texts)]
        extra = "".join(f", {k} string" for k in [*more, *CLASHING])
        return spark.createDataFrame(rows, f"doc_id long, text string{extra}").repartition(3)

    return make
