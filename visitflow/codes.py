"""Category codes the extracts depend on.

Which departments, providers and site-specific elements are in scope is never fixed here: the
plans take those as parameters.
"""

# --- Fixed values: must equal the codes stored in the source warehouse. -------------------------

# Appointment status
SCHEDULED, COMPLETED, CANCELED, NO_SHOW, LEFT, ARRIVED = 1, 2, 3, 4, 5, 6
ACTIVE_STATUSES = (1, 2, 6)
INACTIVE_STATUSES = (3, 4, 5)
STATUS_LABELS = {1: "sch", 2: "comp", 3: "canc", 4: "no show", 5: "left", 6: "arrived"}

# Encounter types counted as face to face
FACE_TO_FACE_TYPES = (
    "1001",  # anticoagulation visit
    "50",  # appointment
    "213",  # dentistry
    "2103500001",  # home visit
    "3",  # hospital encounter
    "108",  # immunization
    "1201",  # initial prenatal
    "101",  # office visit
    "2100700001",  # office visit, financial counselling
    "1003",  # procedure
    "1200",  # routine prenatal
)

# Medication administration
INFUSION_ORDER_TYPE = 1
ACTION_NEW_BAG = 6
ACTION_STOPPED = 8
ACTION_DUE = 100
ACTION_COMPLETED = 120
STOP_ACTIONS = (ACTION_STOPPED, ACTION_COMPLETED)

# Flowsheet measures and templates
MEASURES_SUMMARY_GIVEN = ("2103800002", "2103800003")
MEASURES_PATIENT_VERIFIED = ("3506", "3507")
MEASURE_ROOM = "4143"
MEASURE_TRACK = "4147"
TEMPLATE_NURSE_ASSIGNMENT = "1150000005"
TEMPLATE_SUMMARY_GIVEN = "2103800001"
TEMPLATE_PATIENT_VERIFIED = "2100000001"
TEMPLATE_VITALS = "2100300004"
TEMPLATES_VITALS_MERGED = ("2100300004", "31010", "31000")
TRACK_INTAKE = "B - Intake"
TRACK_CHECKED_OUT = "G- Checked Out"

# Visit events shown on the status board
BOARD_EVENT_TYPES = (
    "1400000222", "2104200001", "2104200002", "1400000227", "1400000225", "1400000234", "57043",
    "1400000226", "1400000233", "1400000224", "1400000237", "1400000238", "2104500001",
    "1400000230", "1400000228", "1400000229", "1400000235", "1400000236", "1400000220", "604",
)

# Referral history entry type that carries the first change date
REFERRAL_FIRST_CHANGE = 1

# --- End of fixed values -------------------------------------------------------------------------
