"""Deterministic stand-ins for the caller's models, used by fixtures and tests.

Each is a factory (zero-argument callable) returning ``fn(prompt) -> reply``,
as ``operators.extract`` expects.  Every decision depends only on the prompt
text, so SQL oracles can reproduce it from the tables (mostly via lengths).
"""

from __future__ import annotations

import json

from ..schema import (
    CUSTOMER_INTENTS,
    DELIVERY_EXCEPTION_TYPES,
    MAX_RETRIES,
    REWORK_FREQUENCIES,
    ROOT_CAUSE_CATEGORIES,
    SENTIMENT_TRAJECTORIES,
)

USER_TAG = "<|im_start|>user\n"
END_TAG = "<|im_end|>"


def user_content(prompt: str) -> str:
    """The user turn of a ChatML prompt (the whole text if it is not ChatML)."""
    i = prompt.find(USER_TAG)
    if i < 0:
        return prompt
    j = prompt.find(END_TAG, i)
    return prompt[i + len(USER_TAG): j if j >= 0 else None]


def first_customer_turn(text: str) -> str | None:
    for line_start in ("Customer: ",):
        i = text.find(line_start)
        if i >= 0:
            rest = text[i + len(line_start):]
            j = rest.find("\nAgent: ")
            k = rest.find("\nCustomer: ")
            ends = [x for x in (j, k) if x >= 0]
            return rest[: min(ends)] if ends else rest
    return None


def record_for_key(k: int, quotes: list[str], intent_reasoning: str) -> dict:
    """Gold-style record for key ``k`` (status F/O/P by ``k % 3``), same rules as FX1."""
    status = "FOP"[k % 3]
    effort = 1 + (k // 10) % 5
    steps = "N/A" if status == "F" else (" n/a " if status == "O" and k % 2 == 0 else "Ticket submitted to hub")
    return {
        "behavioral_analytics": {
            "effort_and_friction_quotes": quotes,
            "customer_intent": CUSTOMER_INTENTS[k % 10],
            "customer_effort_score": effort,
            "sentiment_trajectory": SENTIMENT_TRAJECTORIES[(k // 3) % 3],
            "rework_frequency": REWORK_FREQUENCIES[(k // 7) % 3],
        },
        "operational_analytics": {
            "exception_diagnostic_reasoning": f"exception_diagnostic_reasoning {k}",
            "delivery_exception_type": DELIVERY_EXCEPTION_TYPES[(k // 2) % 3],
            "root_cause_category": ROOT_CAUSE_CATEGORIES[(k // 4) % 6],
            "address_change_requested": k % 10 == 3,
            "missed_delivery_explicitly_mentioned": (k // 2) % 3 == 0,
            "escalation_requested": (k // 10) % 5 == 4,
            "agent_explicitly_confirmed_resolution": status == "F",
            "unresolved_next_steps": steps,
        },
        "diagnostic_reasoning": {
            "recommended_routing_queue": "Tier 2 Support" if effort >= 4 else "Tier 1 Support",
            "intent_reasoning": intent_reasoning,
            "exception_reasoning": f"exception_reasoning {k}",
            "effort_reasoning": f"effort_reasoning {k}",
        },
    }


def extractor_factory():
    """Extraction stand-in: ``k`` = length of the user turn; fails when ``k % 13 == 0``.

    Quotes: the first 20 characters of the first customer turn when ``k`` is even,
    else a sentence not in the text.  ``intent_reasoning`` is the whole first
    customer turn when ``k % 3 == 0``.
    """

    def model(prompt: str) -> str:
        user = user_content(prompt)
        k = len(user)
        if k % 13 == 0:
            raise ValueError(f"boom {k}")
        first = first_customer_turn(user)
        if first is None:
            quotes: list[str] = []
        else:
            quotes = [first[:20]] if k % 2 == 0 else [f"not in text {k}"]
        reasoning = first if (first is not None and k % 3 == 0) else f"intent_reasoning {k}"
        return json.dumps(record_for_key(k, quotes, reasoning), ensure_ascii=False)

    return model


def flaky_factory(failures_of: str):
    """Fails the first ``n`` calls for a prompt, ``n`` from the prompt length:
    ``failures_of="generation"`` -> ``len % 6``, ``"extraction"`` -> ``(len // 6) % 6``.
    Returns the prompt unchanged on success (state is per worker process, and
    a prompt's ends with its success or last try)."""

    def factory():
        calls: dict[str, int] = {}

        def model(prompt: str) -> str:
            n = len(prompt) % 6 if failures_of == "generation" else (len(prompt) // 6) % 6
            c = calls.pop(prompt, 0) + 1
            if c <= n:
                if c < MAX_RETRIES:  # a sample that is given up starts anew when it comes again
                    calls[prompt] = c
                raise RuntimeError(f"{failures_of} unavailable (try {c})")
            return prompt

        return model

    return factory


def generator_factory():
    """Generation stand-in: a short two-turn transcript; blank when ``len(prompt) % 7 == 0``."""

    def model(prompt: str) -> str:
        n = len(prompt)
        if n % 7 == 0:
            return "  \n"
        return f"Agent: Hello, case {n}.\nCustomer: Thanks."

    return model


def case_key_factory():
    """Replies (fenced) with the gold record of the key written as ``case <k>`` in the transcript.

    ``k == 3`` raises; ``k == 2`` answers with a wrong intent.  For end-to-end tests.
    """

    def model(prompt: str) -> str:
        k = int(user_content(prompt).rsplit("case ", 1)[1].split()[0])
        if k == 3:
            raise RuntimeError("model crashed")
        rec = record_for_key(k, [], "r")
        if k == 2:
            rec["behavioral_analytics"]["customer_intent"] = "WISMO_Standard"
        return "```json\n" + json.dumps(rec) + "\n```"

    return model
