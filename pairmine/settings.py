"""Default parameters of every stage."""

# Page extraction.
MIN_ALT_CHARS = 10
MAX_IMAGES_PER_PAGE = 20
MIN_CONTEXT_WORDS = 30
MAX_CONTEXT_CHARS = 2500
MIN_RECORD_BYTES = 128

# Sequences and training.
MAX_LEN = 512
MAX_BEFORE_TOKENS = 250
VALIDATION_SPLIT = 0.2
EARLY_STOPPING_PATIENCE = 10

# Inference and enrichment.
MIN_IMAGE_BYTES = 5 * 1024
MIN_IMAGE_WIDTH = 224
MIN_IMAGE_HEIGHT = 224
PREDICTION_BATCH = 32
ENRICHMENT_BATCH = 100
SIMILARITY_MODEL = "openai/clip-vit-base-patch32"

# Status and error texts stored in the tables.
STATUS_PENDING = "pending"
STATUS_PROCESSED = "processed"
STATUS_SCORED = "clip_scored"
STATUS_FAILED = "failed_clip"
STATUS_FAILED_DOWNLOAD = "failed_download"
ERROR_DOWNLOAD = "Download/Validation failed"
ERROR_SCORING = "CLIP scoring failed"

# Separator inside hashed natural keys; cannot occur in a URL.
KEY_SEPARATOR = "\u0001"

# A table may be broadcast only when its counted rows stay below this.
BROADCAST_ROW_LIMIT = 1_000_000
