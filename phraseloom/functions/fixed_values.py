"""Names, codes, texts and limits that results must carry as they stand."""

# Label codes and their names. -1 marks a parallel pair without a class.
LABEL_NAMES = {0: "Literal", 1: "Idiomatic"}
PARALLEL_LABEL = -1

# Source names, in the order in which sources are concatenated.
SOURCE_LABELLED = "MAGPIE"
SOURCE_TAGGED = "PIE-English"
SOURCE_MULTILINGUAL = "LIDIOMS"
SOURCE_PARALLEL = "Kunchukuttan"
SOURCE_DICTIONARY = "Kaggle-Indian-Idioms"
SOURCE_DICTIONARY_REVERSE = "Kaggle-Indian-Idioms-Reverse"

# Language names and codes.
LANGUAGE_CODES = {"malayalam": "ml", "hindi": "hi", "telugu": "te"}
LANGUAGE_NAMES = {"ml": "malayalam", "hi": "hindi", "te": "telugu"}
DEFAULT_LANGUAGE_NAME = "malayalam"
DEFAULT_LANGUAGE_CODE = "ml"

# Dictionary files and the language of each.
DICTIONARY_LANGUAGES = {"hindi.json": "hi", "malayalam.json": "ml", "telugu.json": "te"}

# Token-length buckets, lower bound included, upper bound excluded; a last one is open.
LENGTH_BOUNDS = [0, 5, 10, 20, 30, 50, 999]

# Thresholds and sizes.
MIN_TOKENS = 3
MIN_ROWS = 3
IMBALANCE_THRESHOLD = 0.4
SPLIT_SEED = 42
PARALLEL_SAMPLE = 10_000
PIPELINE_HITS = 5
GATE_HITS = 3
PAIR_REPORT_ROWS = 15
SAMPLE_REPORT_ROWS = 5
SAMPLE_TEXT_CHARS = 90
BAR_CHARS = 30
FAILURE_DETAIL_CHARS = 240

# Messages of the gate.
MESSAGE_LITERAL = "Input predicted as literal; retrieval skipped."
MESSAGE_NO_INDEX = "Retrieval index not found. Run --mode build first."
MESSAGE_NO_DETECTOR = (
    "Detector model unavailable; retrieval executed directly. Details: {detail}. "
    "If retrieval is empty, build index with --mode build first."
)
DETAIL_BAD_MODEL_MARK = "Unrecognized model in"
DETAIL_BAD_MODEL = "invalid or incomplete detector model directory"
LABEL_UNAVAILABLE = "Unavailable"
MESSAGE_BLANK = "query_text must be non-empty."

# Response texts.
RESPONSE_NO_TEXT = "No text provided"
RESPONSE_LITERAL_CONTEXT = "No idioms detected by XLM-RoBERTa."
RESPONSE_LITERAL_TRANSLATION = "Literal text. Translation bypassed."
RESPONSE_NO_CONTEXT = "No context found in FAISS."
RESPONSE_NO_TRANSLATION = "Error generating translation."
TRANSLATION_FAILED = "Translation Error: Could not connect to API."

# Context line and prompt texts. {language} is the capitalised language name.
CONTEXT_PREFIX = "Related known idioms/meanings: "
SYSTEM_TEXT = (
    "You are an expert bilingual linguist specializing in English and {language}. "
    "Your task is to translate the figurative meaning of English idioms into natural {language}. "
    "1. Analyze the figurative meaning of the provided English idiom. "
    "2. Review the 'Related known idioms/meanings' provided in the context. "
    "3. Select the most culturally accurate equivalent from the context, or generate one if the context is insufficient. "
    "Provide ONLY the final {language} translation in native script, nothing else. Do not add quotes or explanations."
)
PROMPT_IDIOM_LINE = "English Idiom: '{text}'\n"
PROMPT_CONTEXT_LINE = "Figurative Meaning/Context: {context}\n"
PROMPT_LAST_LINE = "{language} Translation:"

# The public "13a" tokenisation of BLEU, as literal and regular-expression replacements.
BLEU_LITERALS = [
    ("<skipped>", ""),
    ("-\n", ""),
    ("\n", " "),
    ("&quot;", '"'),
    ("&amp;", "&"),
    ("&lt;", "<"),
    ("&gt;", ">"),
]
BLEU_PATTERNS = [
    (r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", " $1 "),
    (r"([^0-9])([\.,])", "$1 $2 "),
    (r"([\.,])([^0-9])", " $1 $2"),
    (r"([0-9])(-)", "$1 $2 "),
]
BLEU_MAX_ORDER = 4
