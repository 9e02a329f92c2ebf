"""Code lists, label texts and column names that the result tables depend on."""

from __future__ import annotations

# Laboratory parameter ids as they come in.
LAB_IDS = [
    "ALAT_S", "AP_S", "ASAT_S", "B-BA_E", "B-EO_E", "B-HCT_E", "B-HGB_E", "B-LY_E",
    "B-MCHC_E", "B-MCH_E", "B-MCV_E", "B-MO_E", "B-NE_E", "B-RBC_E", "B-RDW_E", "B-WBC_E",
    "BILI_S", "CA_S", "CKDEPI", "CKMB_S", "CK_S", "CL_S", "CRE_S", "CRP_S",
    "DDIM_C", "FIBC_C", "FIB_C", "G-GLU_K", "GGT_S", "GLU_F", "GLU_S", "HBA1CI_E",
    "HBA1C_E", "HST_S", "IL6_S", "INR_C", "K_S", "LDH_S", "MYOGL_S", "NA_S",
    "O-ABE_Z", "O-BE_Z", "O-BILI_Z", "O-CA++_Z", "O-CHB_Z", "O-CL_Z", "O-FCOHB_Z", "O-FHHB_Z",
    "O-FIO2_Z", "O-FMETHB_Z", "O-FO2HB_Z", "O-GLU_Z", "O-GLU_Z.x", "O-HCO3_Z", "O-HCT_Z", "O-K_Z",
    "O-LAC_Z", "O-NA_Z", "O-O2S_Z", "O-P50T_Z", "O-PCO2T_Z", "O-PCO2_Z", "O-PHT_Z", "O-PH_Z",
    "O-PO2T_Z", "O-PO2_Z", "O-SBC_Z", "O-TEMP", "PBNP_S", "PCT_S", "PTS_C", "PT_C",
    "P_S", "TNT_S", "TSH_S",
]

# The ids kept by the reduced variant.
LAB_IDS_REDUCED = [
    "B-MCH_E", "B-WBC_E", "NA_S", "O-NA_Z", "B-HCT_E", "B-MCV_E", "B-HGB_E", "B-MCHC_E",
    "B-RBC_E", "B-RDW_E", "CKDEPI", "CRE_S", "K_S", "O-K_Z",
]

# One measurement known under several ids -> the common id.
MERGED_IDS = {
    "x-CL_x": ["CL_S", "O-CL_Z"],
    "x-K_x": ["K_S", "O-K_Z", "K_H"],
    "x-NA_x": ["NA_S", "O-NA_Z"],
}
GLUCOSE_MARK = "GLU_"
GLUCOSE_ID = "x-GLU_x"
# A bedside glucose id carries its own clock time as four digits.
CLOCK_ID_PATTERN = r"O-GLU_Z\.\d{4}"
CLOCK_ID_COLLAPSED = "O-GLU_Z.x"
# A blood gas row of this id names the kind of sample, it is no measurement.
SAMPLE_KIND_ID = "O-PROBENTYP"


def common_id(lab_id: str) -> str:
    """The common id of one lab id; the column form is ``functions.codes.common_code``."""
    if GLUCOSE_MARK in lab_id:
        return GLUCOSE_ID
    return next((to for to, many in MERGED_IDS.items() if lab_id in many), lab_id)


# Feature columns: exactly the ids that come out of the merging above.
LAB_FEATURES = list(dict.fromkeys(common_id(i) for i in LAB_IDS))
LAB_FEATURES_REDUCED = list(dict.fromkeys(common_id(i) for i in LAB_IDS_REDUCED))

# The ids of the small blood count profile.
LAB_FEATURES_SMALL = [
    "B-HCT_E", "B-HGB_E", "B-MCHC_E", "B-MCH_E", "B-MCV_E", "B-RBC_E", "B-RDW_E", "B-WBC_E",
    "CRE_S", "x-NA_x",
]

COMORBIDITY_PREFIX = "charlson_group"
COMORBIDITY_GROUPS = list(range(1, 18))
COMORBIDITY_FLAGS = [f"{COMORBIDITY_PREFIX}_{g}" for g in COMORBIDITY_GROUPS]

# Labels, codes and sentinels in the sources.
LABEL_NEGATIVE = "Keine LE (0)"
LABEL_POSITIVE = "LE vorhanden (1)"
MIN_CONFIDENCE = 0.9
PROCEDURE_CODE = "3-222"
INPATIENT = "Stationär"
NO_TIME = "00:00:00"
NO_DATE_YEAR = 1900
MIN_AGE = 18
LOOKBACK_HOURS = 168
