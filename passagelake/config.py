"""Defaults shared by every stage.  All of them are arguments of the public functions."""

# Splitter geometry, in characters.
CHUNK_SIZE = 800
CHUNK_OVERLAP = 120

# Separators from coarse to fine; the empty one is the hard cut.
SEPARATORS = ["\n\n", "\n", ". ", "? ", "! ", "; ", ", ", " ", ""]

# Vectors and index.
EMBED_DIM = 384
EMBED_BATCH = 32
GENERATE_BATCH = 16
METRIC = "cosine"
NLIST = 16
NPROBE = 8
TOP_K = 5

# Longest accepted value per collection field, in characters.
MAX_LENGTHS = {"id": 128, "url": 512, "title": 512, "text": 4096}

# How previews are cut.
PREVIEW_WIDTH = 280
PREVIEW_PLACEHOLDER = " ..."

# Similarity bands, lowest score of each band.
SCORE_BANDS = [(0.55, "good"), (0.45, "fair"), (0.35, "weak")]
LOWEST_BAND = "poor"

# Texts that callers see.
UNTITLED = "Untitled"
INDEX_SLUG = "index"
NO_CONTEXT_ANSWER = "No relevant context found. Cannot answer."
# The system text names whose documentation is being asked about.
SYSTEM_PROMPT = (
    "You are a helpful assistant for the {subject}user documentation. Answer "
    "the user's question using ONLY the numbered context passages provided. "
    "If the answer is not in the context, say you don't know rather than "
    "guessing. Be concise and, when helpful, cite the passage number like [2]."
)

# Scores closer than this many decimals are ties, and ties go to the lower id.
# Without it, copies of one vector would be ordered by floating-point noise.
SCORE_DIGITS = 9

# What may be sent whole to every task.  Beyond it, both sides are shuffled.
SMALL_SIDE_ROWS = 16_384
SMALL_SIDE_BYTES = 128 * 1024 * 1024

# Rows of one cell that meet in one task when both sides are shuffled.
TILE_QUERIES = 4_096
TILE_ITEMS = 32_768

# Largest file piece written per insert batch.
INSERT_BATCH_ROWS = 50_000


def system_prompt(subject: str = "") -> str:
    """The system message, for the documentation of ``subject`` if one is named."""
    return SYSTEM_PROMPT.format(subject=f"{subject} " if subject else "")
