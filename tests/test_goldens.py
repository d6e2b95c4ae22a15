"""Goldens of the original learner's own tests (891-row passenger CSV).

The CSV is not part of the checkout; point ARBORIST_PASSENGER_CSV at a copy
to run these.  Expected values are the original tests' (tolerance 1e-5).
"""

import os

import pytest

from arborist import TreeSettings, fit
from arborist.plans import columns
from arborist.sources.tables import read_csv

CSV = os.environ.get("ARBORIST_PASSENGER_CSV", "")
pytestmark = pytest.mark.skipif(not os.path.isfile(CSV), reason="passenger CSV not available")

REFERENCE = TreeSettings(semantics="reference")


@pytest.fixture(scope="module")
def passengers(spark):
    return read_csv(spark, CSV).drop("Survived")


def test_best_split_of_all_columns(passengers):
    best = columns.rank_columns_by_gini(passengers, "Pclass", None, REFERENCE).where("rank = 1").collect()[0]
    assert (best["feature"], best["kind"], best["selection"]) == ("Fare", "ordinal", "21.6792")
    assert best["child_gini"] == pytest.approx(0.434657, abs=1e-5)
    assert (best["n_left"], best["n_right"]) == (357, 534)


def test_best_categorical_split(passengers):
    best = columns.best_categorical_split(passengers, "Pclass", "Embarked", REFERENCE).collect()[0]
    assert best["selection"] == "C" and best["child_gini"] == pytest.approx(0.57038, abs=1e-5)
    assert (best["n_left"], best["n_right"]) == (168, 723)


def test_leaf_labels_depth_0_and_1(passengers):
    assert fit(passengers, "Pclass", None, REFERENCE.with_(max_depth=0)).nodes[1].label == "3"
    model = fit(passengers, "Pclass", None, REFERENCE.with_(max_depth=1))
    assert (model.nodes[2].label, model.nodes[3].label) == ("1", "3")
