"""Where the jobs keep their tables below a data mart folder."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Layout:
    # Folder names of the layers and of the model bank.
    mart: str = "datamart"
    bank: str = "model_bank"

    @property
    def bronze(self) -> str:
        return f"{self.mart}/bronze/lms"

    @property
    def silver(self) -> str:
        return f"{self.mart}/silver/loan_daily"

    @property
    def labels(self) -> str:
        return f"{self.mart}/gold/label_store"

    def report(self, name: str) -> str:
        return f"{self.mart}/reports/{name}"

    @property
    def predictions(self) -> str:
        return f"{self.mart}/gold/model_predictions"
