"""Fixed values shared by the operators."""

# --- fixed values: class dictionary ------------------------------------------------
CLASS_NAMES = {0: "Bearish", 1: "Bullish", 2: "Neutral"}
N_CLASSES = 3
SEED = 42

# --- fixed values: negations that survive stop-word removal --------------------------
KEPT_NEGATIONS = ["not", "no", "never", "neither", "nor", "none"]

# --- fixed values: English stop words ------------------------------------------------
STOP_WORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours "
    "yourself yourselves he him his himself she she's her hers herself it it's its "
    "itself they them their theirs themselves what which who whom this that that'll "
    "these those am is are was were be been being have has had having do does did "
    "doing a an the and but if or because as until while of at by for with about "
    "against between into through during before after above below to from up down in "
    "out on off over under again further then once here there when where why how all "
    "any both each few more most other some such no nor not only own same so than too "
    "very s t can will just don don't should should've now d ll m o re ve y ain aren "
    "aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven "
    "haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't "
    "shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't"
).split()

# --- fixed values: token prefixes that stemming leaves alone --------------------------
STRUCTURED_PREFIXES = ["ticker_", "url", "user"]

# --- fixed values: class cut-offs on a lexicon compound score -------------------------
LEXICON_CUT = 0.05

# --- fixed values: parameter grids ----------------------------------------------------
TEMPERATURES = [0.5, 0.7, 0.9, 1.0, 1.2, 1.5]
WEIGHT_GRID = [0.0, 0.25, 0.5, 0.75, 1.0]
TAUS = [round(i * 0.05, 2) for i in range(21)]
NOISE_THRESHOLDS = [0.90, 0.95, 0.99]
CONFIDENCE_EDGES = [0.5, 0.6, 0.7, 0.8, 0.9, 1.0]

# --- fixed values: tool names and per-row costs of the cascade -------------------------
TOOLS = ["lexicon", "model", "expert"]
TOOL_COSTS = [0.1, 25.0, 150.0]
