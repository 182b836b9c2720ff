"""Labels and cut points that must equal the reference's outputs.

Fixed values (kept as text, in the order the reports use them):
"""

# Patient risk score bands (score in percent, rounded to 2 decimals first).
RISK_SCORE_HIGH_AT = 50
RISK_SCORE_MEDIUM_AT = 25
RISK_SCORE_BANDS = ("High", "Medium", "Low")

# Patient risk level (at least one readmission).
RISK_LEVELS = ("HIGH", "LOW")

# Admission type against the hospital mean.
COMPARISON = ("ABOVE AVG", "BELOW AVG")

# Provider performance against the benchmark, and the group of encounters without a provider.
PERFORMANCE = ("ABOVE AVG RISK", "PERFORMING WELL")
UNASSIGNED_PROVIDER = "[Unassigned / General Staff]"

# Glycemic control bands of the last HbA1c.
HBA1C_POOR_ABOVE = 8.5
HBA1C_BORDERLINE_FROM = 7.0
GLYCEMIC_BANDS = ("POOR CONTROL", "BORDERLINE", "CONTROLLED")

# Patient risk categories of the classification dataset, in report order.
RISK_CATEGORIES = ("Very High Risk", "High Risk", "Medium Risk", "Low Risk")
