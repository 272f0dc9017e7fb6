from __future__ import annotations

import pytest

from visitloom.params import TaskParams
from visitloom.schemas import TASK
from visitloom.sources.tasks import load_params, task_by_id, task_params

DOCUMENT = (
    '{"startDate":["2024-01-03"],"endDate":["2024-01-28"],"startAge":["10"],"endAge":[50],'
    '"keywords":["lamp,pillow,,rug"],"cities":[],"sex":[""],"professionals":[null],"other":["x"]}'
)


def test_from_json():
    assert TaskParams.from_json(DOCUMENT) == TaskParams(
        start_date="2024-01-03",
        end_date="2024-01-28",
        start_age=10,
        end_age=50,
        keywords=("lamp", "pillow", "rug"),
    )


def test_only_commas_match_nothing():
    assert TaskParams.from_values({"sex": ","}).sex == ()


@pytest.mark.parametrize("document", [None, "", "[]", "nonsense"])
def test_bad_documents_raise(document):
    with pytest.raises(ValueError):
        TaskParams.from_json(document)


def test_bad_values_raise():
    with pytest.raises(ValueError):
        TaskParams.from_values({"startAge": "ten"})
    with pytest.raises(ValueError):
        TaskParams.from_values({"colour": "red"})


def tasks(spark, *rows):
    full = [(i, "t", None, None, None, "session", "new", document) for i, document in rows]
    return spark.createDataFrame(full, TASK)


def test_task_lookup(spark):
    table = tasks(spark, (1, "{}"), (2, DOCUMENT), (3, None), (4, "{}"), (4, "{}"))
    assert task_by_id(table, 2).count() == 1
    assert load_params(table, 1) == TaskParams()
    assert load_params(table, 2) == TaskParams.from_json(DOCUMENT)
    for missing in (9, 4):
        with pytest.raises(LookupError):
            load_params(table, missing)
    with pytest.raises(ValueError):
        load_params(table, 3)


def test_params_as_columns(spark):
    row = task_params(tasks(spark, (2, DOCUMENT))).first()
    assert (row["startDate"], row["endAge"], row["keywords"]) == (
        "2024-01-03", "50", "lamp,pillow,,rug",
    )
    assert (row["cities"], row["professionals"], row["categoryIds"]) == (None, None, None)
    assert task_params(tasks(spark, (5, "{bad"))).first()["sex"] is None
