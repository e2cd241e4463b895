"""Word lists, tables and constants that results depend on.

Everything here is data, stated as plain text. No logic lives in this module.
"""

# English stop words (fixed values, one list in alphabetical order).
STOP_WORDS = """
a about above after again against all am an and any are aren't as at be because been before being
below between both but by can't cannot could couldn't did didn't do does doesn't doing don't down
during each few for from further had hadn't has hasn't have haven't having he he'd he'll he's her
here here's hers herself him himself his how how's i i'd i'll i'm i've if in into is isn't it it's
its itself let's me more most mustn't my myself no nor not of off on once only or other ought our
ours ourselves out over own same shan't she she'd she'll she's should shouldn't so some such than
that that's the their theirs them themselves then there there's these they they'd they'll they're
they've this those through to too under until up very was wasn't we we'd we'll we're we've were
weren't what what's when when's where where's which while who who's whom why why's with won't would
wouldn't you you'd you'll you're you've your yours yourself yourselves
""".split()

# Characters deleted from every token (fixed values).
TOKEN_PUNCTUATION = ",.-!?:;()[]{}<>/\\|@#$%^&*_+=~`´\"'"

# Link schemes and file suffixes that never lead to a page (fixed values).
SKIPPED_SCHEMES = ("mailto:", "tel:")
SKIPPED_SUFFIXES = (
    ".jpg", ".jpeg", ".png", ".gif", ".svg", ".pdf", ".mp4", ".mp3", ".avi", ".mov", ".zip",
)

# URL priority: keyword hits come first (fixed values).
PRIORITY_KEYWORD = "news"
PRIORITY_HIT = 1
PRIORITY_DEFAULT = 5

# Seconds between two requests to one host (fixed value).
POLITENESS_SECONDS = 1

# Near-duplicate detection (fixed values).
SHINGLE_WORDS = 8
SIMILAR_AT = 0.9
SKETCH_FUNCTIONS = ("sha1", "sha224", "sha256", "sha512", "md5")
PERMUTATIONS = 2500

# Gradient clipping bound of the factoriser (fixed value).
CLIP_BOUND = 1e3
