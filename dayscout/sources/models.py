"""Saved pipelines with what must be known of them, and the champion of each kind.

A model is a folder, and a card beside it that is written last: a model without a card is
not there. The champion of a kind is named by the newest of its pointer files, which are
published by a rename that replaces nothing, so a reader always finds a whole model, and
of two promotions at once one is told to look again.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from dayscout.sources.files import Files


class FeatureMismatchError(ValueError):
    """A model was asked for with other features than it was trained on."""


@dataclass(frozen=True)
class ModelCard:
    """``model_type`` is the algorithm, ``trained_at`` the caller's time as text; ``k`` is the
    number of clusters, where there is one."""

    kind: str
    id: int
    model_type: str
    feature_names: tuple[str, ...]
    trained_at: str
    metrics: dict = field(default_factory=dict)
    k: int | None = None

    def dumps(self) -> str:
        return json.dumps(asdict(self), allow_nan=False)

    @classmethod
    def loads(cls, text: str) -> ModelCard:
        raw = json.loads(text)
        return cls(**raw | {"feature_names": tuple(raw["feature_names"])})


@dataclass
class SavedModel:
    model: PipelineModel
    card: ModelCard


class ModelRegistry:
    """Models below one root: ``kind/id`` with ``kind/id.json``, and ``kind/champion/n.json``."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self.files = Files(spark)

    def path(self, kind: str, model_id: int) -> str:
        return f"{self.root}/{kind}/{model_id}"

    def save(self, model: PipelineModel, card: ModelCard) -> str:
        """The path of the saved pipeline. A model is never replaced."""
        path = self.path(card.kind, card.id)
        if self.files.exists(f"{path}.json"):
            raise ValueError(f"{card.kind} {card.id} is saved already")
        model.write().overwrite().save(path)  # what a lost job may have left
        if not self.files.publish(f"{path}.json", card.dumps()):
            raise ValueError(f"{card.kind} {card.id} is saved already")
        return path

    def card(self, kind: str, model_id: int) -> ModelCard:
        return ModelCard.loads(self.files.read(f"{self.path(kind, model_id)}.json"))

    def cards(self, kind: str) -> list[ModelCard]:
        """All models of a kind, by their ids."""
        ids = [f.below.removesuffix(".json") for f in self.files.list(f"{self.root}/{kind}")]
        return [self.card(kind, i) for i in sorted(int(n) for n in ids if n.isdigit())]

    def _pointers(self, kind: str) -> list[int]:
        listed = self.files.list(f"{self.root}/{kind}/champion")
        return sorted(int(f.below[:9]) for f in listed if f.below[9:] == ".json")

    def champion(self, kind: str) -> int | None:
        pointers = self._pointers(kind)
        if not pointers:
            return None
        return json.loads(self.files.read(f"{self.root}/{kind}/champion/{pointers[-1]:09d}.json"))["id"]

    def promote(self, kind: str, model_id: int) -> None:
        """Make a saved model the champion of its kind."""
        self.card(kind, model_id)
        pointers = self._pointers(kind)
        name = f"{(pointers[-1] if pointers else 0) + 1:09d}.json"
        if not self.files.publish(f"{self.root}/{kind}/champion/{name}", json.dumps({"id": model_id})):
            raise RuntimeError(f"another {kind} model was promoted meanwhile")

    def load(
        self, kind: str, features: Sequence[str] | None = None, model_id: int | None = None
    ) -> SavedModel:
        """The champion of a kind, or a named model. ``features`` must be those it was
        trained on, in their order: a pipeline would take any columns of the right number."""
        if model_id is None:
            model_id = self.champion(kind)
        if model_id is None:
            raise ValueError(f"no champion among the {kind} models")
        card = self.card(kind, model_id)
        if features is not None and tuple(features) != card.feature_names:
            raise FeatureMismatchError(
                f"{kind} {model_id} was trained on {', '.join(card.feature_names)}, not {', '.join(features)}"
            )
        return SavedModel(PipelineModel.load(self.path(kind, model_id)), card)
