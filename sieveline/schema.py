"""Names and word lists of assay records. The lists are fixed values: results depend on them as they stand."""

from __future__ import annotations

SENTINEL = "Not specified"

#: The columns whose values together name a task.
CONDITION_COLUMNS = (
    "Test", "Test_Type", "Test_Subject", "Measurement_Type", "Measurement_Conc", "Measurement_Temp", "Measurement_Class", "Measurement_Route", "Measurement_Sex", "Measurement_Formulation",
)

#: Names of columns in their canonical form, by which lower-cased names are matched.
CANONICAL_COLUMNS = (
    "Chemical ID", "Chemical Name", "SMILES_Structure_Parent", "SMILES_Salt", "Test", "Test_Type", "Test_Subject", "Test_Dose", "Measurement_Type", "Measurement_Relation", "Measurement_Value", "Measurement_Value(AtoB)",
    "Measurement_Value(BtoA)", "Measurement_Unit", "Measurement_Conc", "Measurement_Temp", "Measurement_Condition", "Measurement_Class", "Measurement_Route", "Measurement_Sex", "Measurement_Formulation", "Comment",
)

#: Other spellings of some of these columns.
COLUMN_ALIASES = {
    "test_species": "Test_Subject", "measurment_type": "Measurement_Type", "measurment_relation": "Measurement_Relation", "measurment_value": "Measurement_Value", "measurment_unit": "Measurement_Unit", "measurment_condition": "Measurement_Condition",
}

#: What a CSV reader of this kind of file takes as missing.
MISSING_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

#: The columns of the wide matrix, in order.
ENDPOINTS = (
    "Caco2", "pgp_inhibitor", "pgp_substrate", "F20", "F50", "skin_permeability", "HIA", "PAMPA_pH5(bc)", "PAMPA_pH5(mc)", "PAMPA_pH7.4(bc)",
    "PAMPA_pH7.4(mc)", "hydrationE", "Lipophilicity", "Solubility", "BBB_cns(reg)", "BBB_logbb(cls)", "PPBR", "VDss", "BCRP", "OATP1B1_Inhibitor",
    "OATP1B3_Inhibitor", "OATP2B1_Inhibitor", "MATE1_Inhibitor", "fu_df", "fu_deeppk", "t1/2(reg)", "t0.5(cls)", "Efflux_ratio", "CYP1A2_Inhibitor",
    "CYP2B6_Inhibitor", "CYP2C9_Inhibitor", "CYP2C19_Inhibitor", "CYP2D6_Inhibitor", "CYP3A4_Inhibitor", "CYP1A2_Substrate", "CYP2B6_Substrate",
    "CYP2C9_Substrate", "CYP2C19_Substrate", "CYP2D6_Substrate", "CYP3A4_Substrate", "HLM", "RLM", "HLC_Stability", "Clearance_Hepatocyte_AZ",
    "Clearance_Microsome_AZ", "CLp(r)", "CLp(bc)", "MRT", "UGT_substrate", "Clearance_total", "OCT2_Inhibitor", "NR-AhR", "NR-AR", "NR-AR-LBD",
    "NR-Aromatase", "NR-ER", "NR-ER-LBD", "NR-PPAR-gamma", "SR-ARE", "SR-ATAD5", "SR-HSE", "SR-MMP", "SR-p53", "GR", "TR", "Skin Reaction",
    "Respir_tox", "Liver_tox_hepato", "DILI", "hERG", "Micronucleus", "Eye_irritation", "Eye_corrosion", "Carcinogen", "AMES", "ClinTox",
    "Nephro_tox", "Mito_tox", "Hemolytic", "Reprotox", "FDAMDD(reg)", "FDAMDD(bc)", "LD50", "Neuro_tox", "Mouse_pTD50", "Rat_pTD50",
)

#: Free-text names of endpoints in the command-line dialect.
CLI_SYNONYMS = {
    "caco2": "Caco2", "caco 2": "Caco2", "caco-2": "Caco2", "pampa": "PAMPA_pH7.4(bc)", "pampa ph74": "PAMPA_pH7.4(bc)",
    "pampa ph7.4": "PAMPA_pH7.4(bc)", "pampa ph75": "PAMPA_pH7.4(bc)", "pampa apical": "PAMPA_pH7.4(mc)", "pampa basolateral": "PAMPA_pH7.4(bc)",
    "mdck": "Efflux_ratio", "skin permeability": "skin_permeability", "bia skin permeability": "skin_permeability", "hia": "HIA",
    "human intestinal absorption": "HIA", "bbb": "BBB_logbb(cls)", "blood brain barrier": "BBB_logbb(cls)", "brain penetration": "BBB_logbb(cls)",
    "vdss": "VDss", "pgp inhibitor": "pgp_inhibitor", "pgp substrate": "pgp_substrate", "p-gp substrate": "pgp_substrate",
    "p-gp inhibitor": "pgp_inhibitor", "p-gp": "pgp_inhibitor", "p_gp": "pgp_inhibitor", "bcrp inhibitor": "BCRP", "bcrp": "BCRP",
    "efflux ratio": "Efflux_ratio", "efflux_ratio": "Efflux_ratio", "oatp1b1": "OATP1B1_Inhibitor", "oatp1b3": "OATP1B3_Inhibitor",
    "oatp2b1": "OATP2B1_Inhibitor", "mate1": "MATE1_Inhibitor", "oct2": "OCT2_Inhibitor", "cyp1a2": "CYP1A2_Inhibitor", "cyp2b6": "CYP2B6_Inhibitor",
    "cyp2c9": "CYP2C9_Inhibitor", "cyp2c19": "CYP2C19_Inhibitor", "cyp2d6": "CYP2D6_Inhibitor", "cyp3a4": "CYP3A4_Inhibitor",
    "cyp1a2 substrate": "CYP1A2_Substrate", "cyp2b6 substrate": "CYP2B6_Substrate", "cyp2c9 substrate": "CYP2C9_Substrate",
    "cyp2c19 substrate": "CYP2C19_Substrate", "cyp2d6 substrate": "CYP2D6_Substrate", "cyp3a4 substrate": "CYP3A4_Substrate",
    "skin reaction": "Skin Reaction", "respiratory toxicity": "Respir_tox", "liver toxicity": "Liver_tox_hepato", "dili": "DILI", "herg": "hERG",
    "ames": "AMES", "carcinogenicity": "Carcinogen", "neurotoxicity": "Neuro_tox", "nephrotoxicity": "Nephro_tox",
    "mitochondrial toxicity": "Mito_tox", "hemolytic": "Hemolytic", "reproductive toxicity": "Reprotox", "eye irritation": "Eye_irritation",
    "eye corrosion": "Eye_corrosion", "skin irritation": "Skin Reaction", "micronucleus": "Micronucleus", "fdamdd": "FDAMDD(reg)",
    "solubility": "Solubility", "lipophilicity": "Lipophilicity", "logp": "Lipophilicity", "log p": "Lipophilicity", "clogp": "Lipophilicity",
    "alogp": "Lipophilicity", "logd": "Lipophilicity", "plasma protein binding": "PPBR", "ppb": "PPBR", "clearance": "Clearance_total",
    "intrinsic clearance": "Clearance_Hepatocyte_AZ", "clp": "CLp(r)", "mrt": "MRT", "ugt": "UGT_substrate", "gr": "GR", "tr": "TR",
}

#: Free-text names of endpoints in the library dialect.
API_SYNONYMS = {
    "caco2": "Caco2", "caco 2": "Caco2", "caco-2": "Caco2", "pampa": "PAMPA_pH7.4(bc)", "pampa ph74": "PAMPA_pH7.4(bc)",
    "pampa ph7.4": "PAMPA_pH7.4(bc)", "pampa ph75": "PAMPA_pH7.4(bc)", "pampa apical": "PAMPA_pH7.4(mc)", "pampa basolateral": "PAMPA_pH7.4(bc)",
    "pampa ph5": "PAMPA_pH5(bc)", "pampa ph 5": "PAMPA_pH5(bc)", "pampa ph5 apical": "PAMPA_pH5(mc)", "pampa ph5 basolateral": "PAMPA_pH5(bc)",
    "mdck": "Efflux_ratio", "skin permeability": "skin_permeability", "bia skin permeability": "skin_permeability", "hia": "HIA",
    "human intestinal absorption": "HIA", "bbb": "BBB_logbb(cls)", "blood brain barrier": "BBB_logbb(cls)", "brain penetration": "BBB_logbb(cls)",
    "bbb cns": "BBB_cns(reg)", "brain cns": "BBB_cns(reg)", "vdss": "VDss", "volume of distribution": "VDss", "vd": "VDss",
    "pgp inhibitor": "pgp_inhibitor", "pgp substrate": "pgp_substrate", "p-gp substrate": "pgp_substrate", "p-gp inhibitor": "pgp_inhibitor",
    "p-gp": "pgp_inhibitor", "p_gp": "pgp_inhibitor", "bcrp inhibitor": "BCRP", "bcrp": "BCRP", "breast cancer resistance protein": "BCRP",
    "efflux ratio": "Efflux_ratio", "efflux_ratio": "Efflux_ratio", "oatp1b1": "OATP1B1_Inhibitor", "oatp1b3": "OATP1B3_Inhibitor",
    "oatp2b1": "OATP2B1_Inhibitor", "mate1": "MATE1_Inhibitor", "oct2": "OCT2_Inhibitor", "cyp1a2": "CYP1A2_Inhibitor",
    "cyp inhibition cyp1a2": "CYP1A2_Inhibitor", "cyp1a2 inhibition": "CYP1A2_Inhibitor", "cyp2b6": "CYP2B6_Inhibitor",
    "cyp inhibition cyp2b6": "CYP2B6_Inhibitor", "cyp2b6 inhibition": "CYP2B6_Inhibitor", "cyp2c9": "CYP2C9_Inhibitor",
    "cyp inhibition cyp2c9": "CYP2C9_Inhibitor", "cyp2c9 inhibition": "CYP2C9_Inhibitor", "cyp2c19": "CYP2C19_Inhibitor",
    "cyp inhibition cyp2c19": "CYP2C19_Inhibitor", "cyp2c19 inhibition": "CYP2C19_Inhibitor", "cyp2d6": "CYP2D6_Inhibitor",
    "cyp inhibition cyp2d6": "CYP2D6_Inhibitor", "cyp2d6 inhibition": "CYP2D6_Inhibitor", "cyp3a4": "CYP3A4_Inhibitor",
    "cyp inhibition cyp3a4": "CYP3A4_Inhibitor", "cyp3a4 inhibition": "CYP3A4_Inhibitor", "cyp3a4 mdz": "CYP3A4_Inhibitor",
    "cyp3a4 tst": "CYP3A4_Inhibitor", "cyp1a2 substrate": "CYP1A2_Substrate", "cyp2b6 substrate": "CYP2B6_Substrate",
    "cyp2c9 substrate": "CYP2C9_Substrate", "cyp2c19 substrate": "CYP2C19_Substrate", "cyp2d6 substrate": "CYP2D6_Substrate",
    "cyp3a4 substrate": "CYP3A4_Substrate", "solubility": "Solubility", "aqueous solubility": "Solubility", "lipophilicity": "Lipophilicity",
    "logp": "Lipophilicity", "log p": "Lipophilicity", "alogp": "Lipophilicity", "clogp": "Lipophilicity", "hydration energy": "hydrationE",
    "hydration": "hydrationE", "fu": "fu_df", "fraction unbound": "fu_df", "unbound fraction": "fu_df", "fu deeppk": "fu_deeppk",
    "half life": "t1/2(reg)", "t1/2": "t1/2(reg)", "t12": "t1/2(reg)", "t0.5": "t0.5(cls)", "t05": "t0.5(cls)", "plasma protein binding": "PPBR",
    "ppb": "PPBR", "clearance": "Clearance_total", "intrinsic clearance": "Clearance_Hepatocyte_AZ",
    "hepatocyte clearance": "Clearance_Hepatocyte_AZ", "microsome clearance": "Clearance_Microsome_AZ",
    "microsomal clearance": "Clearance_Microsome_AZ", "clp": "CLp(r)", "clp bc": "CLp(bc)", "clearance plasma": "CLp(r)", "mrt": "MRT",
    "mean residence time": "MRT", "ugt": "UGT_substrate", "ugt substrate": "UGT_substrate", "hlm": "HLM", "human liver microsome": "HLM",
    "human liver microsomes": "HLM", "rlm": "RLM", "rat liver microsome": "RLM", "rat liver microsomes": "RLM", "liver microsome": "HLM",
    "liver microsomes": "HLM", "metabolic stability liver microsomes": "HLM", "metabolic stability liver microsomes phase ii": "HLM",
    "hlc stability": "HLC_Stability", "hepatocyte stability": "HLC_Stability", "metabolic stability hepatocytes": "HLC_Stability",
    "hepatocytes": "HLC_Stability", "metabolic stability hepatocytes phase ii": "HLC_Stability", "ahr": "NR-AhR",
    "aryl hydrocarbon receptor": "NR-AhR", "ar": "NR-AR", "androgen receptor": "NR-AR", "ar lbd": "NR-AR-LBD", "androgen receptor lbd": "NR-AR-LBD",
    "aromatase": "NR-Aromatase", "er": "NR-ER", "estrogen receptor": "NR-ER", "er lbd": "NR-ER-LBD", "estrogen receptor lbd": "NR-ER-LBD",
    "ppar gamma": "NR-PPAR-gamma", "ppar-gamma": "NR-PPAR-gamma", "are": "SR-ARE", "antioxidant response element": "SR-ARE", "atad5": "SR-ATAD5",
    "hse": "SR-HSE", "heat shock element": "SR-HSE", "mmp": "SR-MMP", "mitochondrial membrane potential": "SR-MMP", "p53": "SR-p53", "gr": "GR",
    "glucocorticoid receptor": "GR", "tr": "TR", "thyroid receptor": "TR", "skin reaction": "Skin Reaction", "respiratory toxicity": "Respir_tox",
    "liver toxicity": "Liver_tox_hepato", "dili": "DILI", "drug induced liver injury": "DILI", "herg": "hERG", "herg channel": "hERG",
    "toxicity herg": "hERG", "toxicity | herg": "hERG", "ames": "AMES", "ames test": "AMES", "toxicity ames": "AMES", "toxicity | ames": "AMES",
    "cytotoxicity": "ClinTox", "toxicity cytotoxicity": "ClinTox", "toxicity | cytotoxicity": "ClinTox", "genetoxicity": "Micronucleus",
    "toxicity genetoxicity": "Micronucleus", "toxicity | genetoxicity": "Micronucleus", "carcinogenicity": "Carcinogen", "carcinogen": "Carcinogen",
    "neurotoxicity": "Neuro_tox", "nephrotoxicity": "Nephro_tox", "mitochondrial toxicity": "Mito_tox", "hemolytic": "Hemolytic",
    "hemolysis": "Hemolytic", "reproductive toxicity": "Reprotox", "reprotox": "Reprotox", "eye irritation": "Eye_irritation",
    "eye corrosion": "Eye_corrosion", "skin irritation": "Skin Reaction", "micronucleus": "Micronucleus", "fdamdd": "FDAMDD(reg)",
    "fdamdd bc": "FDAMDD(bc)", "ld50": "LD50", "lethal dose 50": "LD50", "clintox": "ClinTox", "clinical toxicity": "ClinTox",
    "mouse ptd50": "Mouse_pTD50", "mouse ptd 50": "Mouse_pTD50", "rat ptd50": "Rat_pTD50", "rat ptd 50": "Rat_pTD50", "f20": "F20", "f 20": "F20",
    "f50": "F50", "f 50": "F50",
}

#: The controlled vocabulary of the columns that are checked.
VOCABULARY = {
    "Test": (
        "Brain_penetration", "CYP_Inhibition", "Efflux_transporter", "In_vivo_PK", "Metabolic_stability", "Permeability", "Physicochem",
        "Plasma_protein_binding", "Plasma_stability", "Solubility", "Toxicity",
    ),
    "Test_Type": (
        "Ames", "BBB_PAMPA", "BCRP", "CYP1A1", "CYP1A2", "CYP2B6", "CYP2C19", "CYP2C8", "CYP2C9", "CYP2D6", "CYP3A4_MDZ", "CYP3A4_TST",
        "Cytotoxicity", "Genetoxicity", "Hepatocytes", "Hepatocytes_Phase_II", "Liver_Microsomes_Phase_II", "Liver_microsomes", "PK_ip", "PK_iv",
        "PK_po", "PK_sc", "P_gp", "Total_BBB", "Unbound_BBB", "hERG",
    ),
    "Measurement_Type": (
        "AUCExtra", "AUCinf", "AUClast", "BA", "CC50", "CLhep", "CLint", "Clearance", "Clearance/F", "Cmax", "Co", "IC50", "Inhibition",
        "Inhibition_10uM", "Inhibition_1uM", "Kp", "Kp_uu", "MRT", "Papp", "Pe", "Remaining_10min", "Remaining_30min", "Remaining_60min", "Rsq",
        "SOS Chromotest", "T1/2", "TA100_S9+", "TA100_S9-", "TA102_S9+", "TA102_S9-", "TA1535_S9+", "TA1535_S9-", "TA1537_S9+", "TA1537_S9-",
        "TA97_S9+", "TA97_S9-", "TA97a_S9+", "TA97a_S9-", "TA98_S9+", "TA98_S9-", "Tmax", "Vd", "Vd/F", "Vss", "Vz", "WP2uvrA(pKM101)_S9+",
        "WP2uvrA(pKM101)_S9-", "WP2uvrA_S9+", "WP2uvrA_S9-", "X", "efflux_Ratio",
    ),
}
