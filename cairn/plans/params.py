"""Parameters of the named queries (shared by the Spark side and the SQL oracle)."""

SEED = 42          # every random step
SALT_K = 8         # salt values of the salted word count
N_CENTRES = 4      # the first N_CENTRES points (by id) serve as fixed centres
K = 5              # clusters
L = 4              # coreset parts
ITER = 2           # Lloyd steps
SEQ_K = 25         # the sequential pipeline's k
SEQ_ITER = 3       # and iterations
CDF_X = 0.5        # fixed x of the inverse-CDF draw
DIGITS = 6         # rounding of computed doubles
NORM_DIGITS = 9    # rounding of normalised values
