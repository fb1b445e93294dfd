"""Constants, formats and texts shared by every job."""

# Special tokens and their ids, and the byte alphabet's offset.
UNK_TOKEN = "[UNK]"
PAD_TOKEN = "[PAD]"
UNK_ID = 0
PAD_ID = 1
FIRST_BYTE_ID = 2
BASE_VOCAB_SIZE = 258

# Label of positions without a training target.
IGNORE_INDEX = -100

# Default sizes.
SEED = 42
MAX_SEQ_LEN = 2048
VOCAB_SIZE = 32768
TOKENIZER_SAMPLE_SIZE = 10000
VAL_EXAMPLES = 1000
BATCH_SIZE = 32
ACCUMULATION_STEPS = 8
EVAL_INTERVAL = 500

# Request limits and sampling defaults.
MAX_MESSAGES = 50
MAX_CONTENT_CHARS = 8000
MAX_NEW_TOKENS_CEILING = 512
DEFAULT_MAX_NEW_TOKENS = 50
DEFAULT_TEMPERATURE = 1.0
DEFAULT_TOP_P = 1.0
DEFAULT_TOP_K = 0
DEFAULT_REPETITION_PENALTY = 1.0
MIN_POSITIVE_TEMPERATURE = 0.01
MAX_TEMPERATURE = 2.0
MAX_REPETITION_PENALTY = 2.0

# Texts of rejected requests.
NO_MESSAGES_TEXT = "messages must be a non-empty list"
TOO_MANY_MESSAGES_TEXT = "messages has {count} entries, exceeds limit of {limit}"
INVALID_ROLE_TEXT = "message {i} has invalid role {role}; must be 'user' or 'assistant'"
EMPTY_CONTENT_TEXT = "message {i} must have non-empty string 'content'"
CONTENT_TOO_LONG_TEXT = "message {i} content is {count} chars, exceeds limit of {limit}"
WRONG_TURN_TEXT = (
    "messages must alternate starting with 'user'; message {i} has role {role}, expected {expected}"
)
ENDS_ON_ASSISTANT_TEXT = "messages must end on a 'user' turn"
CONTEXT_TOO_LONG_TEXT = "prompt exceeds max_seq_len even after truncating all prior turns"

# Python's texts for values int() and float() refuse.
NOT_AN_INT_TEXT = "invalid literal for int() with base 10: {value}"
NOT_A_FLOAT_TEXT = "could not convert string to float: {value}"
INT_TYPE_TEXT = (
    "int() argument must be a string, a bytes-like object or a real number, not '{type}'"
)
FLOAT_TYPE_TEXT = "float() argument must be a string or a real number, not '{type}'"

# Chat markup.
TURN_TEMPLATE = "<|{role}|>\n{content}\n"
TURN_START = "<|"
ASSISTANT_OPENER = "<|assistant|>\n"

# Judge call defaults and discard reasons.
JUDGE_MAX_ATTEMPTS = 3
JUDGE_RETRY_SECONDS = 5.0
DISCARD_REASONS = (
    "position_bias_disagreement",
    "parse_failure",
    "api_failure",
    "degenerate_pair",
)

# The self-check question and its two answers.
SELF_CHECK_PAIR = (
    "What is 2+2?",
    "4",
    "The answer is definitely 5, I am very confident.",
)

# Preference-tuning strength.
DPO_BETA = 0.1

# Byte-level word pattern (Java regex, Unicode-aware white space).
WORD_PATTERN = (
    r"(?U)'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

# The text sent to the judge.
JUDGE_TEMPLATE = """You are evaluating two AI assistant responses to the same user prompt.

Guidelines:
- Judge only correctness, helpfulness, and relevance to the prompt.
- Do NOT prefer a response merely because it is longer or more detailed. A shorter, correct,
  on-point answer beats a longer one that pads with unnecessary detail or repetition. For
  example, given "What is 2+2?", the response "4" is better than a paragraph explaining basic
  arithmetic before arriving at "4".
- You must pick exactly one response as better. Ties are not allowed -- if genuinely close,
  break the tie on correctness, then relevance, then clarity, in that order.
- First write 1-2 sentences of reasoning, then give your verdict.

<prompt>
{prompt}
</prompt>

<response_a>
{response_a}
</response_a>

<response_b>
{response_b}
</response_b>"""
