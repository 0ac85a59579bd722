"""A labeler without a service: answers follow from the length of the text."""

from __future__ import annotations

import json

from lotwise.schemas import BASEMENT_SUITE, CONSTRUCTION_TYPES, STANDARD

MODEL = "stub"


def label(batch: list[tuple[str, str]]) -> str:
    """Every 7th length gets no answer, every 9th a label that is not in the list."""
    answers = []
    for permit_num, description in batch:
        n = len(description)
        if n % 7 == 0:
            continue
        answers.append(
            {
                "permit_num": permit_num,
                "unit_form": BASEMENT_SUITE if "suite" in description.lower() else STANDARD,
                "construction_type": "guess" if n % 9 == 0 else CONSTRUCTION_TYPES[n % 8],
            }
        )
    return json.dumps({"classifications": answers})
