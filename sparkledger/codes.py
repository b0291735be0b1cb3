"""Code sets used by the jobs. They are part of the data model, not tunables."""

# Reversal state of a cash flow.
CURRENT = 4200
REVERSED = 4201
REVERSAL = 4202

# Settlement state of a cash flow.
PENDING = 2100
SETTLED = 2101

# Cash flow types.
FLOW_RENTAL = 1001
FLOW_CUSTOM = 1010
FLOW_DEPOSIT = 1014
FLOW_WRITE_OFF = 1034

# Product styles.
STYLE_LOAN = 2011
STYLE_RENTAL = 2014

# Contract states.
CONTRACT_ACTIVATED = 11130
CONTRACT_PART_TERMINATED = 11140
CONTRACT_TERMINATED = 11150

# Contract credit states seen in the event queue.
CREDIT_EXPIRED = 11030
CREDIT_PENDING = 12020
CREDIT_DECLINED = 12040
APPROVAL_PENDING = 6500
EVENT_CREDIT_STATE = 24903

# Contract save state "pending ledger entries".
SAVE_PENDING_GL = 2201

# Physical asset states.
ASSET_ACTIVE = 43030
ASSET_QUOTING = 43040
ASSET_RESERVED = 43050

# Quote states.
QUOTE_QUOTING = 44000
QUOTE_EXPIRED = 44010
QUOTE_RESERVED = 44020
QUOTE_ACTIVE = 44030
QUOTE_TERMINATED = 44040
OPEN_QUOTES = (QUOTE_QUOTING, QUOTE_RESERVED)

# Address types of a physical asset; 45101 is the current address.
ADDRESS_TYPES = (45100, 45101, 45102)
ADDRESS_CURRENT = 45101

SYSTEM_USER = 3
COLLECTION_NONE = 14800
NO_DATE = "1900-01-01"

# Audit change codes.
AUDIT_CHANGES = {0: "None", 1: "Insert", 2: "Update", 3: "Delete", 4: "Queued"}

# Field ids of alterations that block a restructure.
BLOCKING_ALTERATIONS = (548, 549, 550, 552, 553)
