"""Fixed values the analysis depends on."""

# Disposition codes grouped under their standard code.
DISPOSITION_GROUPS = {
    "RPC": ("RPC", "RIGHT_PARTY_CONTACT", "CONTACTED"),
    "PTP": ("PTP", "PROMISE_TO_PAY"),
    "WRONG_PARTY": ("WRONG_NUMBER", "INVALID"),
    "CALLBACK": ("CALLBACK", "CALL_BACK"),
}

# Raw dispositions the operations view counts as right-party contact.
RPC_LIKE = ("PTP", "PROMISE_TO_PAY", "PAID", "CALLBACK")

# Promise outcomes that resolve a promise (OPEN is unresolved).
RESOLVED_PROMISES = ("KEPT", "BROKEN", "CANCELLED")

# Message events that count as engagement, per channel.
WHATSAPP_ENGAGED = ("DELIVERED", "READ", "CLICKED")
SMS_ENGAGED = ("DELIVERED", "CLICKED")

SUCCESS = "SUCCESS"
ANSWERED = "ANSWERED"
KEPT = "KEPT"
PAID = "PAID"

DEFAULT_ZONE = "Asia/Kolkata"

# Days-past-due bands, right-closed: (-1, 7], (7, 30], ...
DPD_EDGES = (-1, 7, 30, 60, 90, 180, 999)
DPD_LABELS = ("0-7", "8-30", "31-60", "61-90", "91-180", "181+")

# Planning case for the investment question.
INVESTMENT_COST = 100_000_000
LIFTS = (0.02, 0.05, 0.08)
CRORE = 10_000_000

# Attribution windows in days.
CONVERSION_DAYS = 14
SENSITIVITY_DAYS = (1, 7, 14, 30)
