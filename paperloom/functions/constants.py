"""Fixed values that results depend on: word lists, digits, limits and weights, as the applications use them."""

# --- fixed values: characters -------------------------------------------------------------------
ARABIC_DIGITS = "٠١٢٣٤٥٦٧٨٩"
PERSIAN_DIGITS = "۰۱۲۳۴۵۶۷۸۹"
ASCII_DIGITS = "0123456789"
#: Marks over letters and the lengthening stroke, by code point.
TASHKEEL = "[\\u0617-\\u061A\\u064B-\\u0652\\u0670\\u0640]"
ARABIC_LETTER = "[\\u0600-\\u06FF]"
#: What stays in an answer that must be Arabic.
NOT_ARABIC = "[^\\u0600-\\u06FF0-9\\s.،؛:!؟()\\-/]"

# --- fixed values: word lists -------------------------------------------------------------------
URGENT = ["طارئ", "عاجل", "مستعجل", "دلوقتي", "ضروري", "بأسرع وقت", "محتاج حالاً"]
FINANCIAL = ["فلوس", "مال", "مبلغ", "دين", "مساعدة مادية"]
MEDICAL = ["علاج", "عملية", "دواء", "أدوية", "مستشفى", "مرض"]
FOOD = ["تموين", "طعام", "غذاء", "أكل"]
THANKS = ["شكراً", "ممتن", "جزاكم الله خير", "متشكر"]
LOCATIONS = ["القاهرة", "الإسكندرية", "الجيزة", "الشرقية", "سوهاج", "المنصورة", "طنطا", "بنها", "الفيوم"]
STOP_WORDS = ["في", "من", "على", "عن", "إلى", "و", "أن", "هذا", "الذي", "التي"]
#: Dialect words and their standard forms, replaced in this order.
DIALECT = [("عايز", "أحتاج"), ("محتاج", "أحتاج"), ("مش", "ليس"), ("بتاع", "لـ"), ("دلوقتي", "الآن"), ("بكره", "غداً"), ("النهاردة", "اليوم"), ("حأ", "سوف")]
#: Number words, replaced in this order.
NUMBER_WORDS = [
    ("واحد", "one"), ("اثنين", "two"), ("اتنين", "two"), ("تلاتة", "three"), ("ثلاثة", "three"), ("أربعة", "four"), ("اربعة", "four"),
    ("خمسة", "five"), ("ستة", "six"), ("سبعة", "seven"), ("ثمانية", "eight"), ("تمانية", "eight"), ("تسعة", "nine"), ("عشرة", "ten"), ("عشر", "ten"),
    ("مئة", "hundred"), ("مائة", "hundred"), ("ميت", "hundred"), ("ألف", "thousand"), ("الف", "thousand"), ("ألفين", "two thousand"), ("الفين", "two thousand"), ("مليون", "million"),
]
LOW_CONFIDENCE = ["غير واضح", "لا يمكن", "غير معروف", "لا أستطيع"]
OVERRIDE_WORDS = ["نعم", "لا", "غير"]
FRONT_CUES = ["بيان بجميع أفراد", "البيانات الأولية", "اسم رب الأسرة"]
BACK_CUES = ["الحالة الاجتماعية", "الحالة الصحية", "توقيع الباحث", "احتياجات الأسرة"]
IMAGE_SUFFIXES = [".png", ".jpg", ".jpeg", ".tif", ".tiff", ".bmp", ".webp"]

# --- fixed values: limits and weights -----------------------------------------------------------
CONTEXT_CHARS, HISTORY_CHARS = 4000, 900
#: The notice that the passages hold no answer.
INSUFFICIENT_EN = "Insufficient FAQ context"
INSUFFICIENT_AR = "لا توجد إجابة في الأسئلة الشائعة الحالية"
RISK_AI, RISK_OTHER_USER, RISK_SAME_USER, RISK_QUALITY = 0.5, 0.3, 0.2, 0.2
RISK_HIGH, RISK_MEDIUM = 0.75, 0.4
SIGNAL_AI, SIGNAL_QUALITY = 0.7, 0.5
MAX_LOOPS = 3
BAND_CORRECT, BAND_WRONG = 0.85, 0.50
ACCEPT_CATALOG = 75
SEGMENT_SECONDS = 15
SHARP_ENOUGH, MIN_SIDE = 300.0, 400
SPLIT_AFTER = 32

# --- fixed values: record fields ----------------------------------------------------------------
LIST_FIELDS = ["family_members", "assets", "attachments", "uncertain_fields", "review_notes"]
CASE_FIELDS = [
    "document_id", "source_files", "page_count", "case_office", "social_unit", "research_date", "researcher_name", "research_purpose",
    "head_of_household_name", "head_of_household_age", "national_id", "insurance_id", "phone", "address_center", "address_governorate", "current_job",
    "family_members", "housing_type", "housing_area", "rooms_count", "water_available", "water_source", "furniture_status", "rent_amount",
    "housing_independence", "assets", "social_status_summary", "health_status_summary", "economic_status_summary", "family_needs", "previous_aid",
    "attachments", "uncertain_fields", "review_required", "review_notes",
]
CERTIFICATE_FIELDS = [
    "document_title_ar", "serial_number", "registration_number", "registration_date", "issue_date", "health_office", "civil_registry", "issuing_authority",
    "governorate_or_administration", "form_reference", "issuance_system_version", "barcode_or_machine_notes",
]
MEMBER_FIELDS = ["name", "relation", "age", "national_id", "social_status", "education_status", "employment_status", "health_status"]
ATTACHMENT_FIELDS = ["attachment_type", "subject_name", "national_id", "notes"]
CHILD_FIELDS = ["name", "gender", "religion", "nationality", "place_of_birth", "date_of_birth"]
PARENT_FIELDS = ["name", "religion", "nationality"]
#: Field classes, their boxes (x, y of the centre, width, height) and where a record holds them.
SEED_BOXES = [
    ("child_national_id", 0.52, 0.17, 0.38, 0.04, "$.ids.child_national_id"),
    ("registration_number", 0.36, 0.74, 0.15, 0.04, "$.birth_certificate.registration_number"),
    ("registration_date", 0.23, 0.78, 0.22, 0.04, "$.birth_certificate.registration_date"),
    ("issue_date", 0.23, 0.82, 0.22, 0.04, "$.birth_certificate.issue_date"),
    ("child_name", 0.56, 0.405, 0.36, 0.045, "$.personal_and_other.child.name"),
    ("child_gender", 0.22, 0.36, 0.18, 0.04, "$.personal_and_other.child.gender"),
    ("child_religion", 0.23, 0.325, 0.20, 0.04, "$.personal_and_other.child.religion"),
    ("child_nationality", 0.78, 0.28, 0.18, 0.04, "$.personal_and_other.child.nationality"),
    ("place_of_birth", 0.68, 0.32, 0.40, 0.04, "$.personal_and_other.child.place_of_birth"),
    ("date_of_birth", 0.69, 0.35, 0.37, 0.04, "$.personal_and_other.child.date_of_birth"),
    ("father_name", 0.56, 0.515, 0.40, 0.045, "$.personal_and_other.father.name"),
    ("father_religion", 0.74, 0.485, 0.18, 0.04, "$.personal_and_other.father.religion"),
    ("father_nationality", 0.76, 0.535, 0.17, 0.04, "$.personal_and_other.father.nationality"),
    ("mother_name", 0.56, 0.635, 0.42, 0.045, "$.personal_and_other.mother.name"),
    ("mother_religion", 0.74, 0.60, 0.18, 0.04, "$.personal_and_other.mother.religion"),
    ("mother_nationality", 0.76, 0.66, 0.17, 0.04, "$.personal_and_other.mother.nationality"),
    ("health_office", 0.63, 0.745, 0.32, 0.045, "$.birth_certificate.health_office"),
    ("civil_registry", 0.62, 0.785, 0.34, 0.045, "$.birth_certificate.civil_registry"),
    ("serial_number", 0.60, 0.865, 0.28, 0.045, "$.birth_certificate.serial_number"),
]
