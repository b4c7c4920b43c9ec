"""Metrics record schema, controlled vocabularies and the field-rule table.

Everything here is data: StructTypes, vocabulary lists and small tables that
the operators turn into column expressions.  Nothing is computed on import.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values.  These strings must equal the reference's exactly (labels are
# compared as text), so they are stated here verbatim, in their declared order.
# ---------------------------------------------------------------------------

SYSTEM_PROMPT = (
    "You are a SOTA Logistics AI. Extract the exact logistics and CX metrics "
    "from the following transcript."
)

DELIVERY_EXCEPTION_TYPES = [
    "DEX08 - Recipient Not In/Business Closed",
    "STAT84 - Delay Beyond our Control",
    "Unknown / Not Explicitly Stated",
]

CUSTOMER_INTENTS = [
    "WISMO_Standard",
    "WISMO_Stalled_Label",
    "Intercept_Request",
    "Address_Modification",
    "Delivery_Scheduling",
    "Proof_of_Delivery_Dispute",
    "Damage_Claim_Initiation",
    "Lost_in_Transit_Investigation",
    "Hazmat_Documentation_Hold",
    "Customs_Clearance_Inquiry",
]

ROOT_CAUSE_CATEGORIES = [
    "Address, Location, and Recipient Failures",
    "Environmental and Force Majeure Events",
    "Operational, Mechanical, and Technological Failures",
    "Documentation and Labeling Deficiencies",
    "Hazardous Materials (Hazmat) and Dangerous Goods Violations",
    "Unknown / Not Applicable",
]

SENTIMENT_TRAJECTORIES = [
    "Improved - Customer ended calmer or more satisfied than they started",
    "Worsened - Customer ended more frustrated or angry than they started",
    "Unchanged - Customer maintained the exact same emotional state throughout",
]

REWORK_FREQUENCIES = [
    "0 - No rework, customer stated issue once",
    "1 - Customer had to repeat or clarify themselves exactly once",
    "2+ - Chronic rework, customer had to repeatedly correct the agent or restate facts",
]

# Defaults pydantic fills on a validated record (absent key only, never null).
DEFAULT_DELIVERY_EXCEPTION = "Unknown / Not Explicitly Stated"
DEFAULT_ROOT_CAUSE = "Unknown / Not Applicable"

# Comparison order used by the evaluation (exact-match fields), then the
# normalized resolution check.  recommended_routing_queue is excluded on purpose.
BEHAVIORAL_KEYS = [
    "customer_intent",
    "customer_effort_score",
    "sentiment_trajectory",
    "rework_frequency",
]
OPERATIONAL_KEYS = [
    "delivery_exception_type",
    "root_cause_category",
    "address_change_requested",
    "missed_delivery_explicitly_mentioned",
    "escalation_requested",
    "agent_explicitly_confirmed_resolution",
]
ALL_KEY_FIELDS = BEHAVIORAL_KEYS + OPERATIONAL_KEYS
RESOLVED_FIELD = "unresolved_next_steps"
SCORED_FIELDS = ALL_KEY_FIELDS + [RESOLVED_FIELD]

GROUPS = ["behavioral_analytics", "operational_analytics", "diagnostic_reasoning"]

# Channels, personas and scenarios of the synthetic generator (3 x 8 x 8).
CHANNELS = [
    "Voice Call (include spoken interruptions, IVR mentions, 'can you hear me', holds)",
    "Live Web Chat (include typos, short fragmented messages, informal tone)",
    "Email Thread (asynchronous, formal replies, time gaps mentioned)",
]
PERSONAS = [
    "Furious & High Urgency (e.g., missed medical supplies or passport; highly emotional)",
    "Confused & Tech-Illiterate (e.g., elderly; doesn't understand the app or tracking portal)",
    "Calm but Analytical (e.g., has Ring camera footage proving driver didn't stop; demands proof)",
    "The Third-Party Recipient (e.g., receiving a gift; doesn't have the sender's billing info)",
    "Small Business / B2B (e.g., shipping in bulk; angry about SLAs; uses terms like 'freight')",
    "Terse & Impatient (e.g., one-word answers; refuses to verify address easily; wants it fixed NOW)",
    "Verbose & Chatty (e.g., over-explains the backstory, buries the actual problem in long paragraphs)",
    "Language Barrier (e.g., uses simple vocabulary, broken grammar; struggles to explain physical locations)",
]
SCENARIOS = [
    "Intent: WISMO (Where is my order) | Reality: (Recipient Not In/Business Closed)",
    "Intent: WISMO (Where is my order) | Reality: (Customs Hold/Missing Commercial Invoice)",
    "Intent: Address Modification | Reality: (Customer Delay - Package already on truck, cannot intercept)",
    "Intent: Proof of Delivery Dispute | Reality: (Delivered to Address Other than Recipient / Misdelivered)",
    "Intent: Damage Claim Initiation | Reality: (Observed Package Damage at Hub prior to delivery)",
    "Intent: Delivery Scheduling | Reality: (Hold at Location successfully processed)",
    "Intent: Lost in Transit Investigation | Reality: (Missort routing loop between two hubs)",
    "Intent: WISMO (Where is my order) | Reality: (Weather/Force Majeure Delay)",
]
GENERATOR_SYSTEM_PROMPT = (
    "You are an expert at writing realistic customer support dialogue for logistics "
    "and shipping companies. Output only the transcript, no preamble."
)

# Retry policy of the generator: attempts per stage, first wait, cap (seconds).
MAX_RETRIES = 5
INITIAL_BACKOFF_SEC = 2
MAX_BACKOFF_SEC = 60

# Sequence budget of the fine-tuning run (tokens).
MAX_SEQ_LENGTH = 2048

# Release manifest: files a published dataset / model repository must hold,
# and the split names the dataset viewer must expose.
REQUIRED_DATASET_FILES = ["README.md", "train.jsonl", "test.jsonl"]
REQUIRED_MODEL_FILES = [
    "README.md",
    "adapter_config.json",
    "adapter_model.safetensors",
    "tokenizer.json",
    "tokenizer_config.json",
]
REQUIRED_SPLITS = ["train", "test"]

# ---------------------------------------------------------------------------
# Vocabulary table: field -> allowed values (declaration order = ordinal).
# ---------------------------------------------------------------------------

VOCABULARIES: dict[str, list[str]] = {
    "delivery_exception_type": DELIVERY_EXCEPTION_TYPES,
    "customer_intent": CUSTOMER_INTENTS,
    "root_cause_category": ROOT_CAUSE_CATEGORIES,
    "sentiment_trajectory": SENTIMENT_TRAJECTORIES,
    "rework_frequency": REWORK_FREQUENCIES,
}

# The declared name of each value, in the same order.
VOCABULARY_NAMES: dict[str, list[str]] = {
    "delivery_exception_type": ["DEX08", "STAT84", "UNKNOWN"],
    "customer_intent": [
        "WISMO_STANDARD",
        "WISMO_STALLED_LABEL",
        "INTERCEPT_REQUEST",
        "ADDRESS_MODIFICATION",
        "DELIVERY_SCHEDULING",
        "PROOF_OF_DELIVERY_DISPUTE",
        "DAMAGE_CLAIM_INITIATION",
        "LOST_IN_TRANSIT_INVESTIGATION",
        "HAZMAT_DOCUMENTATION_HOLD",
        "CUSTOMS_CLEARANCE_INQUIRY",
    ],
    "root_cause_category": [
        "ADDRESS_LOCATION_RECIPIENT_FAILURES",
        "ENVIRONMENTAL_FORCE_MAJEURE",
        "OPERATIONAL_MECHANICAL_TECHNOLOGICAL",
        "DOCUMENTATION_LABELING_DEFICIENCIES",
        "HAZARDOUS_MATERIALS_VIOLATIONS",
        "UNKNOWN_OR_NOT_APPLICABLE",
    ],
    "sentiment_trajectory": ["IMPROVED", "WORSENED", "UNCHANGED_FLAT"],
    "rework_frequency": ["NONE", "SINGLE", "MULTIPLE"],
}


# ---------------------------------------------------------------------------
# Field-rule table.  One row per leaf; the validator turns it into columns.
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class FieldRule:
    group: str
    name: str
    kind: str  # "str", "int", "bool", "enum", "str_list"
    required: bool = True
    default: object = None
    vocab: tuple[str, ...] | None = None
    lo: int | None = None
    hi: int | None = None

    @property
    def path(self) -> str:
        return f"{self.group}.{self.name}"


FIELD_RULES: list[FieldRule] = [
    FieldRule("behavioral_analytics", "effort_and_friction_quotes", "str_list"),
    FieldRule("behavioral_analytics", "customer_intent", "enum", vocab=tuple(CUSTOMER_INTENTS)),
    FieldRule("behavioral_analytics", "customer_effort_score", "int", lo=1, hi=5),
    FieldRule("behavioral_analytics", "sentiment_trajectory", "enum", vocab=tuple(SENTIMENT_TRAJECTORIES)),
    FieldRule("behavioral_analytics", "rework_frequency", "enum", vocab=tuple(REWORK_FREQUENCIES)),
    FieldRule("operational_analytics", "exception_diagnostic_reasoning", "str"),
    FieldRule("operational_analytics", "delivery_exception_type", "enum", required=False,
              default=DEFAULT_DELIVERY_EXCEPTION, vocab=tuple(DELIVERY_EXCEPTION_TYPES)),
    FieldRule("operational_analytics", "root_cause_category", "enum", required=False,
              default=DEFAULT_ROOT_CAUSE, vocab=tuple(ROOT_CAUSE_CATEGORIES)),
    FieldRule("operational_analytics", "address_change_requested", "bool", required=False, default=False),
    FieldRule("operational_analytics", "missed_delivery_explicitly_mentioned", "bool", required=False, default=False),
    FieldRule("operational_analytics", "escalation_requested", "bool", required=False, default=False),
    FieldRule("operational_analytics", "agent_explicitly_confirmed_resolution", "bool"),
    FieldRule("operational_analytics", "unresolved_next_steps", "str"),
    FieldRule("diagnostic_reasoning", "recommended_routing_queue", "str"),
    FieldRule("diagnostic_reasoning", "intent_reasoning", "str"),
    FieldRule("diagnostic_reasoning", "exception_reasoning", "str"),
    FieldRule("diagnostic_reasoning", "effort_reasoning", "str"),
]

RULES_BY_NAME = {r.name: r for r in FIELD_RULES}

_SPARK_TYPES = {
    "str": T.StringType(),
    "enum": T.StringType(),
    "int": T.IntegerType(),
    "bool": T.BooleanType(),
    "str_list": T.ArrayType(T.StringType()),
}


def group_struct(group: str) -> T.StructType:
    return T.StructType(
        [T.StructField(r.name, _SPARK_TYPES[r.kind], True) for r in FIELD_RULES if r.group == group]
    )


METRICS_SCHEMA = T.StructType([T.StructField(g, group_struct(g), True) for g in GROUPS])

MESSAGE_SCHEMA = T.StructType(
    [T.StructField("role", T.StringType(), True), T.StructField("content", T.StringType(), True)]
)
CHATML_SCHEMA = T.StructType([T.StructField("messages", T.ArrayType(MESSAGE_SCHEMA), True)])

# Generation prompt of the synthetic pipeline (fixed text; {channel}, {persona},
# {scenario} are filled per sample).
GENERATION_PROMPT_TEMPLATE = """Generate a single, realistic logistics customer-support transcript with 6–10 turns.

Constraints:
- Channel: {channel}
- Customer persona: {persona}
- Scenario (intent vs operational reality): {scenario}

Rules:
- The CUSTOMER must speak only in layman's terms (no internal codes like DEX08, STAT50, etc.). They describe the situation in plain language.
- The AGENT diagnoses the issue professionally and with empathy, and may use internal codes in their own reasoning/notes only if appropriate for the channel (e.g., not read aloud on a call in a robotic way).
- Format each turn clearly as "Agent:" or "Customer:" followed by the message.
- Make the conversation coherent and specific to the scenario and persona."""
