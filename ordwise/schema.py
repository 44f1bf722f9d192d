"""Record layout and generator constants.

Fixed values: these must equal the published benchmark definition, otherwise the
generated records, keys and checksums differ from the reference's.
"""

# --- fixed values (record layout) ------------------------------------------------
KEY_LEN = 10          # bytes of sort key at the start of a record
VALUE_LEN = 90        # bytes of payload after the key
RECORD_LEN = 100      # KEY_LEN + VALUE_LEN, no delimiter, no header
BREAK_1 = bytes.fromhex("0011")        # record bytes 10-11
BREAK_2 = bytes.fromhex("8899AABB")    # record bytes 44-47
BREAK_3 = bytes.fromhex("CCDDEEFF")    # record bytes 96-99
RECNO_DIGITS = 32     # record number as uppercase hex, zero padded (bytes 12-43)
# filler = hex digits 20..31 of the random state ...
FILLER_DIGITS = 12
FILLER_REPEAT = 4         # ... each written 4 times (bytes 48-95)

# --- fixed values (128-bit linear congruential generator) ------------------------
# X[0] = 0, X[k+1] = (LCG_MUL * X[k] + LCG_ADD) mod 2**128; record i uses X[i+1].
LCG_MUL = 0x2360ED051FC65DA44385DF649FCCF645
LCG_ADD = 0x4A696D47726179524950202020202001

# --- fixed values (even-range partitioner) ---------------------------------------
PREFIX_BYTES = 7                      # big-endian key prefix used for ranges
PREFIX_MAX = (1 << (8 * PREFIX_BYTES)) - 1   # 2**56 - 1
