"""Question types, difficulties and prompt templates.

The question-type catalogue is a small dimension (15 rows) that users can
extend (``Corpus(extra_types=...)``); templates are plain format strings with named slots that are
compiled into one ``CASE question_type WHEN … THEN concat(…)`` expression, so
rendering stays a JVM-side projection (no string ``replace`` chains, hence no
accidental substitution inside inserted text).
"""

from __future__ import annotations

import string

# The fifteen question types in catalogue order with their
# difficulty (they must equal the reference's mapping).
QUESTION_TYPES: tuple[tuple[int, str, str], ...] = (
    (1, "FACTUAL_RECALL", "easy"),
    (2, "INFERENCE", "medium"),
    (3, "MULTI_HOP_REASONING", "hard"),
    (4, "APPLICATION", "medium"),
    (5, "COMPARATIVE_ANALYSIS", "medium"),
    (6, "CAUSE_EFFECT", "medium"),
    (7, "SUMMARIZATION", "easy"),
    (8, "HYPOTHETICAL", "hard"),
    (9, "CRITICAL_ANALYSIS", "hard"),
    (10, "TECHNICAL_EXPLANATION", "medium"),
    (11, "PROCESS_WORKFLOW", "easy"),
    (12, "TRUE_FALSE_FILL_BLANK", "easy"),
    (13, "CONTEXTUAL_AMBIGUITY", "hard"),
    (14, "FACT_BASED", "easy"),
    (15, "SECTION_SUMMARY", "medium"),
)
FACT_TYPE = "FACT_BASED"
SUMMARY_TYPE = "SECTION_SUMMARY"
RECALL_TYPE = "FACTUAL_RECALL"
PAIR_TYPES = ("MULTI_HOP_REASONING", "COMPARATIVE_ANALYSIS")
# Default section titles (single-section types / pair types).
DEFAULT_TITLE, DEFAULT_TITLE_A, DEFAULT_TITLE_B = "Section", "Section A", "Section B"
DEFAULT_DOC_TITLE = "the document"
NO_NEIGHBOURS = "No additional relevant sections found"


def unit_of(question_type: str) -> str:
    if question_type == FACT_TYPE:
        return "fact"
    if question_type in PAIR_TYPES:
        return "pair"
    return "section"


SYSTEM_PROMPT = (
    "You write question/answer pairs for training data from document sections. "
    "Questions must stand alone; answers must be complete and in the source's tone. "
    "Reply with a single JSON object using double quotes only."
)

_COMMON = """
Guidelines:
1. Name the source as "{doc_title}" in the third person (for example "{doc_title} states ...").
2. Do not write in the first person.
3. Only list an image in question_images when the question needs that image; copy its path exactly.
4. The answer must stand on its own and may use markdown lists or emphasis.
5. The question must be unambiguous and answerable from the given text alone.
6. Keep the technical level and vocabulary of the source.
"""

_JSON_SHAPE = """
Reply with one JSON object and nothing else, using double quotes:
{{"question": "...", "question_images": ["folder/image.png"], "answer": "..."}}
"""

_CONTEXT = """
{metadata}{instructions}
Source section:
{section}

Related sections of the same document:
{neighbours}

{images}"""

_ONE = "\nSection:\n\n{title}\n\n{body}\n"
_TWO = "\nFirst section: {title_a}\n{body}\n\nSecond section: {title_b}\n{body2}\n"

_TASKS: dict[str, str] = {
    "FACT_BASED": "Write one question whose answer is the fact below, and answer it in detail.\n"
                  "{metadata}{instructions}\nSection containing the fact:\n{section}\n\n"
                  "Related sections:\n{fact_neighbours}\n\nFact:\n{fact}\n\n{images}",
    "SECTION_SUMMARY": "Ask for a summary of the section and answer with a summary that covers every key point."
                       "{context}" + _ONE,
    "FACTUAL_RECALL": "Ask a question that one or two sentences of the section answer verbatim; quote them."
                      "{context}" + _ONE + "\nA fact you may focus on:\n\n{seed_fact}\n",
    "INFERENCE": "Ask a question whose answer must be inferred from the section; explain the reasoning."
                 "{context}" + _ONE,
    "MULTI_HOP_REASONING": "Ask a question that needs both sections below; show how each contributes."
                           "{context}" + _TWO,
    "APPLICATION": "Describe a practical scenario and ask how the section's guidance applies; answer step by step."
                   "{context}" + _ONE,
    "COMPARATIVE_ANALYSIS": "Ask a question comparing the two sections below; list similarities and differences."
                            "{context}" + _TWO,
    "CAUSE_EFFECT": "Ask about a cause and its effect described in the section; explain the link."
                    "{context}" + _ONE,
    "SUMMARIZATION": "Ask for a brief summary (under 100 words) of the section and give it."
                     "{context}" + _ONE,
    "HYPOTHETICAL": "Pose a realistic what-if question that extends the section and reason it through."
                    "{context}" + _ONE,
    "CRITICAL_ANALYSIS": "Ask for a critical assessment of a claim or method in the section; weigh strengths and weaknesses."
                         "{context}" + _ONE,
    "TECHNICAL_EXPLANATION": "Ask how a complex process in the section works; explain it in plain words that a lay reader follows."
                             "{context}" + _ONE,
    "PROCESS_WORKFLOW": "Ask about the order of steps of a process in the section; answer with numbered steps."
                        "{context}" + _ONE,
    "TRUE_FALSE_FILL_BLANK": "Write a true/false or fill-in-the-blank item from the section and give the answer with a reason."
                             "{context}" + _ONE,
    "CONTEXTUAL_AMBIGUITY": "Ask about a statement whose meaning depends on context and show how the section resolves it."
                            "{context}" + _ONE,
}


def parse(fmt: str) -> list[tuple[str, str | None]]:
    """Template -> [(literal, slot or None)]."""
    return [(lit, field) for lit, field, _, _ in string.Formatter().parse(fmt)]


def _expand(fmt: str) -> str:
    return fmt.replace("{context}", _CONTEXT) + _JSON_SHAPE


def compile_template(task: str) -> list[tuple[str, str | None]]:
    """A template from a task text; it may use the slots of ``SLOTS`` and ``{context}`` (section, neighbours, images)."""
    return parse(_expand(task))


TEMPLATES: dict[str, list[tuple[str, str | None]]] = {t: compile_template(f) for t, f in _TASKS.items()}
COMMON_PARTS = parse(_COMMON)
SLOTS = sorted({f for parts in TEMPLATES.values() for _, f in parts if f})
