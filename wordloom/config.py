"""Settings and table schemas."""

from __future__ import annotations

from dataclasses import dataclass, field

MODES = ("like", "regexp", "fulltext")
METHODS = ("scan", "tokens")
SORTS = ("score", "score-recency", "date", "id")
DIRECTIONS = ("asc", "desc")

# Section weighting 0..4 and the factor it multiplies scores by.
WEIGHT_FACTORS = {0: 4.0, 1: 2.0, 2: 1.0, 3: 0.5, 4: 0.25}
WEIGHT_LABELS = {0: "Highest", 1: "High", 2: "Medium (none)", 3: "Low", 4: "Lowest"}
DEFAULT_WEIGHTING = 2

DOC_INDEX_SCHEMA = "entry_id LONG, section_id INT, data STRING, data_lc STRING"
POSTINGS_SCHEMA = "entry_id LONG, section_id INT, keyword STRING, frequency INT, tf INT"
LOG_SCHEMA = (
    "id LONG, date TIMESTAMP, keywords STRING, keywords_manipulated STRING, "
    "sections STRING, page INT, results INT, session_id STRING"
)
QUERY_SCHEMA = (
    "qid INT, keywords STRING, sections STRING, sort STRING, direction STRING, "
    "page INT, per_page INT"
)


@dataclass(frozen=True)
class SectionIndex:
    """How one section is indexed: which fields, its weighting, and entry filters.

    A filter maps a column to ``"a, b"`` (any of), ``"a+b"`` (all of) with ``\\,`` for a
    literal comma; the column ``id`` filters on the entry id.
    """

    section_id: int
    fields: tuple[str, ...] = ()
    weighting: int | None = None
    filters: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class SearchConfig:
    default_sections: str = ""
    default_per_page: int = 20
    default_sort: str = "score"
    default_direction: str = "desc"
    excerpt_length: int = 250
    min_word_length: int = 3
    max_word_length: int = 30
    stem_words: bool = True
    mode: str = "like"
    suggest_limit: int = 50
    # Full text: unsigned words are required, or match as beginnings of words.
    append_all_words_required: bool = False
    append_wildcard: bool = False
    # Whether a word's stem also counts as a match (off: only the word itself).
    match_stems: bool = False
    # Whether synonyms of several words are looked for too.
    synonym_phrases: bool = False
    # Whether letters with and without accents are the same in substring and word matches.
    fold_accents: bool = False
    # How words are found: "tokens" goes through the vocabulary and a token index, for any number;
    # "scan" tests every one on every text, for batches of few words.
    method: str = "tokens"

    def __post_init__(self):
        check_choice("mode", self.mode, MODES)
        check_choice("method", self.method, METHODS)
        check_choice("sort", self.default_sort, SORTS)
        check_choice("direction", self.default_direction, DIRECTIONS)
        if self.default_per_page <= 0:
            raise ValueError("default_per_page must be positive")


def check_choice(name: str, value: str, allowed: tuple[str, ...]) -> str:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {', '.join(allowed)}; got {value!r}")
    return value
