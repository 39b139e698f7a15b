"""Category vocabularies, lookup tables, patterns and column lists.

Everything in this module is data that must have exactly these values for results to agree
with the established reports. Values that name one particular site or business unit are
parameters (see ``page_rules`` and the configuration classes in ``leadloom.plans``).
"""

from __future__ import annotations

# --- fixed values: contact defaults -------------------------------------------------
ZERO_FILL = {
    "PageDirectoryPortfolioPlanner": 0,
    "PageDirectoryRetirementPlanning": 0,
    "PageDirectoryMarketOutlook": 0,
    "PageDirectoryArticles": 0,
    "PageDirectoryWhitepaper": 0,
    "PageDirectoryDiversification": 0,
    "PageDirectoryInvestorTypeSurvey": 0,
    "PageDirectoryInvestmentPlanner": 0,
    "AgeRange": 0,
}
TEXT_DEFAULTS = {
    "WasTheProspectInterestedInInvestment": "Cannot be determined",
    "WasTheCampaignMessageUnderstood": "Cannot be determined",
    "MaritalStatus": "Cannot be determined",
    "PreferredLanguage": "English",
    "City": "Cannot be Determined",
}

# --- fixed values: category normalisation -------------------------------------------
CAMPAIGN_KEYWORDS = (
    "retire",
    "diverse",
    "direct traffic",
    "osol",
    "club",
    "aos",
    "organic",
    "professional",
    "argaam",
    "lookalike",
)
CAMPAIGN_DEFAULT = "others"
GENDER_ANSWERS = {"Yes": "Male", "No": "Female"}
NATIONALITY_VARIANTS = {
    "saudi": "saudi arabia",
    "saudi arabian": "saudi arabia",
    "sa": "saudi arabia",
    "saudi araboa": "saudi arabia",
    "saudi rabia": "saudi arabia",
    "sudi": "saudi arabia",
    "saudi_arabian": "saudi arabia",
    "ksa": "saudi arabia",
    "ٍsaudi": "saudi arabia",
    "ٍsa": "saudi arabia",
    "sdudi": "saudi arabia",
    "bahraini": "bahrain",
    "bahrein": "bahrain",
}
NATIONALITY_FLAGS = ("bahrain", "indian", "saudi arabia")


def page_rules(site: str, site_label: str) -> list[tuple[str, str]]:
    """Ordered landing-page patterns for one web site (``site`` occurs in its host names)."""
    return [
        (r".*linkedin.*", "linkedin"),
        (r".*client.*", "Client App"),
        (rf".*my.{site}.*", "PJ"),
        (rf".*{site}.*", "Website"),
        (rf".*{site_label}.*", "Website"),
        (r".*facebook.*", "Facebook"),
    ]


# --- fixed values: ordinal and target maps ------------------------------------------
STAGE_ORDINAL = {
    "INACTIVE": 0,
    "Dormant Lead": 1,
    "LOST": 0,
    "Booked Meeting": 3,
    "Meeting face 2 face": 6,
    "COMMITTED CAPITAL": 12,
    "RISK QUESTIONNAIRE ANSWERED": 4,
    "60+ DAYS TO CLOSE": 8,
    "15 DAYS TO CLOSE": 9,
    "OFFER SENT": 10,
    "KYC Submitted": 11,
    "Account Opened": 11,
    "Account Closed": 0,
    "Others": 0,
}
ENGAGEMENT_ORDINAL = {"Low": 0, "Medium": 1, "High": 2}
CONVERSION_TARGET = {"SAL 2": 0, "SAL 1": 0, "Client": 1}
OUTCOME_TEXT = {
    "COMPLETED": "Meeting was successfully completed",
    "SCHEDULED": "Meeting is scheduled for future",
    "CANCELED": "Meeting was canceled",
    "RESCHEDULED": "Meeting was rescheduled",
    "NO_SHOW": "Contact did not attend",
}
OUTCOME_MISSING = "No outcome recorded"
AGE_BANDS = {
    "age_range_below_21": "Below 20",
    "age_range_21_30": "21 - 30",
    "age_range_31_40": "31 - 40",
    "age_range_41_50": "41 - 50",
    "age_range_51_60": "51 - 60",
    "age_range_over_60": "Above 60",
}

# --- fixed values: relative date bins -----------------------------------------------
DATE_BIN_EDGES = (0, 547, 730, 912, 1095)
DATE_BIN_LABELS = (
    "0 to 1.5 years ago",
    "1.5 to 2 years ago",
    "2 to 2.5 years ago",
    "2.5 to 3 years ago",
    "3+ years ago",
)
DAYS_PER_MONTH = 30.44
MISSING_DAYS = 999
DAYS_SINCE_COLUMNS = (
    "LastContactedDate",
    "ProspectJourneySignUpDate",
    "RmNotificationDate",
    "GAA23EntryDate",
    "InvestorGoalAccessedDate",
    "InvestorGoalCompletedDate",
    "InvestorProfileAccessedDate",
    "InvestorProfileCompletedDate",
    "RiskAssessmentAccessedDate",
    "RiskAssessmentCompletedDate",
    "FollowUpDate",
    "FirstMeetingDate",
    "LastMeetingDate",
    "FirstCallDate",
    "LastCallDate",
)

# --- fixed values: note segments ----------------------------------------------------
SEGMENTS = (-1, 0, 1, 2)
MEETING_SEGMENT_TEXT = {
    -1: "Unclustered or insufficient notes",
    0: "General meeting notes - Cluster 0",
    1: "General meeting notes - Cluster 1",
    2: "General meeting notes - Cluster 2",
}
CALL_SEGMENT_TEXT = {
    -1: "Unclustered or insufficient call notes",
    0: "General call notes - Cluster 0",
    1: "General call notes - Cluster 1",
    2: "General call notes - Cluster 2",
}

# --- fixed values: contraction rules, applied in this order ---------------------------
CONTRACTIONS = (
    ("can't", "cannot"),
    ("won't", "will not"),
    ("n't", " not"),
    ("'re", " are"),
    ("'s", " is"),
    ("'ll", " will"),
    ("'d", " would"),
    ("'ve", " have"),
    ("'m", " am"),
)

# --- fixed values: English stop words -------------------------------------------------
# Entries with an apostrophe are left out: they cannot occur once punctuation is removed.
STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
    she her hers herself it its itself they them their theirs themselves what which who whom
    this that these those am is are was were be been being have has had having do does did doing
    a an the and but if or because as until while of at by for with about against between into
    through during before after above below to from up down in out on off over under again
    further then once here there when where why how all any both each few more most other some
    such no nor not only own same so than too very s t can will just don should now d ll m o re
    ve y ain aren couldn didn doesn hadn hasn haven isn ma mightn mustn needn shan shouldn wasn
    weren won wouldn
    """.split()
)

# --- fixed values: column lists -------------------------------------------------------
ONE_HOT_COLUMNS = (
    "MaritalStatus",
    "Gender",
    "CampaignType",
    "PreferredLanguage",
    "UTMCampaignFirstTouch",
    "UTMSourceFirstTouch",
    "WasTheCampaignMessageUnderstood",
    "WasTheProspectInterestedInInvestment",
    "ContactType",
)
PREPARATION_DROPS = (
    "PersonId",
    "ClientType",
    "BirthPlace",
    "GenderIdentity",
    "BirthCountry",
    "BecameAnOpportunityDate",
    "ClickedAnyOtherLinkLeadGenEmail",
    "ClickedPjLinkLeadGenEmail",
    "DealInterestedProspectJourney",
    "DoYouHaveSignificantExposureToAnyAssetsYouWouldLikeExcludedFromYourPortfolio",
    "IsThisLeadAlreadyFoundInAnInternalDatabase",
    "LastTransitionDate",
    "OpenedLeadGenEmail",
    "ReceivedLeadGenEmail",
    "SignUpDateLeadGenAndProspectJourney",
    "SimulatorFlow",
    "WhatAreYourGoalsForThisInvestmentOtherDetails",
    "AreYouAnAccreditedInvestor",
    "PayInInstallments",
    "NumberofPageViews",
    "OriginalSource",
    "LastPageSeen",
    "ReasonForDisqualification",
    "RecentSalesEmailOpenedDate",
    "RecentSalesEmailClickedDate",
    "OtherCommentPA",
    "OtherCommentsRM",
    "AreYouAQualifiedInvestorExecutionFlow",
    "LastContacted",
    "DoesTheEmaiLookReal",
    "CouldTheLeadBeaRelevantClientForDFOOrTFO",
    "ClearOutPhoneCountryName",
    "RetailClient",
)
FINAL_DROPS = ("DAYSTOCLOSE", "ValidFrom", "ValidUntil", "ContactOwnerId")
LEAD_NON_FEATURES = (
    "GAA23PriorityPassRequested",
    "LeadScoreProspectJourney",
    "GAA23PriorityPass",
    "EstimatedClientSegment",
    "Team",
    "Flow",
    "HashID",
    "CreateDay",
    "BirthYear",
    "ExpectedClosingProbability",
    "SourceExtractionDate",
    "HsPersona",
    "PK_HS_Contact",
    "ProspectJourneyQualificationStatus",
    "SourceOfFundsConsolidated",
    "CloseDate",
    "HS_DaysToClose",
    "DealCloseDateCommittedCapitalContact",
    "WeekNumber",
    "YearNumber",
    "LeadStageNewCEO",
    "LeadStageNew",
    "TotalDealAmount",
    "ExistingMappedLeadStages",
    "LeadStage",
    "OnboardingId",
    "TotalDealAmountDS",
    "ExpectedMonthOfclosing",
    "GAA23ListMembership",
    "GAA23InviteeType",
    "GAA23EntryDate",
    "HSLeadStatus",
    "IPCountry",
    "BirthDate",
    "InterestedFlow",
    "PropensityScoreDFOSALs",
    "GAA23EntryTime",
    "GAA23CheckedInBy",
    "HubSpotId",
    "CreateDate",
    "ContactType",
    "created_at",
    "pipeline_run_id",
    "Target",
    "ContactOwnerId",
    "DAYSTOCLOSE",
    "ValidFrom",
    "ValidUntil",
    "MeetingNotesPreview",
    "CallNotesPreview",
    "SegmentClass",
    "Country",
    "FirstPageSeen",
    "Nationality",
    "EngagementLabel",
    "AgeRange",
    "CreateDate_Bins",
    "City",
)
CONVERSION_NON_FEATURES = (
    "GAA23PriorityPassRequested",
    "LeadScoreProspectJourney",
    "GAA23PriorityPass",
    "EstimatedClientSegment",
    "Team",
    "Flow",
    "HashID",
    "CreateDay",
    "ContactOwnerId",
    "BirthYear",
    "ExpectedClosingProbability",
    "SourceExtractionDate",
    "HsPersona",
    "SegmentCount_0",
    "ProspectJourneyQualificationStatus",
    "SourceOfFundsConsolidated",
    "CloseDate",
    "HS_DaysToClose",
    "DealCloseDateCommittedCapitalContact",
    "DAYSTOCLOSE",
    "WeekNumber",
    "YearNumber",
    "LeadStageNewCEO",
    "LeadStageNew",
    "TotalDealAmount",
    "ExistingMappedLeadStages",
    "LeadStage",
    "OnboardingId",
    "TotalDealAmountDS",
    "ExpectedMonthOfclosing",
    "GAA23ListMembership",
    "GAA23InviteeType",
    "GAA23EntryDate",
    "HSLeadStatus",
    "IPCountry",
    "BirthDate",
    "InterestedFlow",
    "PropensityScoreDFOSALs",
    "GAA23EntryTime",
    "GAA23CheckedInBy",
    "IPCity",
)
TOPUP_NON_FEATURES = (
    "HubSpotId",
    "Client ID",
    "TOPUP",
    "TOPUPAMOUNT",
    "created_at",
    "pipeline_run_id",
    "Client Summary",
    "Client Empathy Map",
    "Psychology Profile",
    "RM_Name",
    "Top Up Frequency",
    "they_topped_up",
    "Activities per Quarter",
    "Hubspot_Persona",
    "MEETINGNOTESAGGREGATED",
    "CALLNOTESAGGREGATED",
    "meetingnotesaggregated",
    "callnotesaggregated",
    "meetingnotespreview",
    "callnotespreview",
    "emailbodypreview",
    "maildata",
    "client_summary",
    "client_empathy_map",
    "psychology_profile",
)
TOPUP_CATEGORIES = (
    "ContactType",
    "LeadStageNew",
    "Nationality",
    "MaritalStatus",
    "EmploymentField",
    "ShariaCompliant",
    "AgeRange",
    "TypeOfReferral",
    "Gender",
    "wealth_range",
    "engagement_label",
    "client_approached_us",
    "share_of_wallet_label",
    "digital_campaign_influence",
)
TOPUP_METADATA = (
    "Top Up Frequency",
    "they_topped_up",
    "Activities per Quarter",
    "Hubspot_Persona",
    "RM_Name",
    "Client Summary",
    "Client Empathy Map",
    "Psychology Profile",
)
CLUSTER_NON_FEATURES = ("Client_ID", "HubSpotId", "OnboardingId", "SegmentClass")
TOPUP_SOURCE_COLUMNS = (
    "Client ID",
    "ContactType",
    "LeadStageNew",
    "Nationality",
    "SegmentClass",
    "DealCloseDateCommittedCapitalContact",
    "wealth_range",
    "engagement_label",
    "client_approached_us",
    "share_of_wallet_label",
    "digital_campaign_influence",
    "MaritalStatus",
    "EmploymentField",
    "ShariaCompliant",
    "AgeRange",
    "TypeOfReferral",
    "Gender",
    "TotalWebinarsAttended",
    "TotalWebinarsRegistered",
    "MarketingEmailsClicked",
    "MarketingEmailsOpened",
    "MarketingEmailsDelivered",
    "TotalCallsConnected",
    "TotalCallsMade",
    "meetscounts",
    "MEETINGNOTESAGGREGATED",
    "CALLNOTESAGGREGATED",
    "callscountsconnected",
    "opened_counts",
    "clicked_counts",
    "delivered_counts",
    "maildata",
    "ContactType_DFO",
    "ContactType_TFO",
    "FORMS_FILLED",
    "numberofformsfilled",
    "WEBSITEVISTED",
    "numberofwebvisits",
    "CLIENTAPP",
    "numberofclientappvisits",
    "PJVISITED",
    "PJVISITS",
    "Total Top Ups",
    "Total Top Up Amount",
    "total_commitment",
    "AssetClass_Cash & Cash Equivalent",
    "AssetClass_Credit",
    "AssetClass_Equities",
    "AssetClass_Multi-Asset Class",
    "AssetClass_Others",
    "AssetClass_Private Equity",
    "AssetClass_Real Estate",
    "AssetClass_Yielding Investments",
    "SubStrategy_Absolute Return",
    "SubStrategy_Capital Growth",
    "SubStrategy_Capital Yielding",
    "SubStrategy_Opportunistic",
    "SubStrategy_Others",
    "First Commitment Amount",
    "DEALCLOSEDATECOMMITTEDCAPITAL",
    "Top Up Frequency",
    "they_topped_up",
    "Activities per Quarter",
    "Hubspot_Persona",
    "RM_Name",
    "Client Summary",
    "Client Empathy Map",
    "Psychology Profile",
)
# Columns computed from the top-up outcome itself; they would leak the target.
TOPUP_TARGET_DERIVED = ("Total Top Ups", "Total Top Up Amount", "Top Up Frequency")
LEAD_LONG_TEXT = ("meetingnotespreview", "callnotespreview", "notes")
TOPUP_LONG_TEXT = (
    "meetingnotesaggregated",
    "callnotesaggregated",
    "meetingnotespreview",
    "callnotespreview",
    "emailbodypreview",
    "maildata",
    "client_summary",
    "client_empathy_map",
    "psychology_profile",
)

# --- fixed values: one-hot groups of the missing-data rule ----------------------------
MISSING_GROUPS = {
    "age_range": [
        "age_range_below_21", "age_range_21_30", "age_range_31_40",
        "age_range_41_50", "age_range_51_60", "age_range_over_60",
    ],
    "MaritalStatus": [
        "MaritalStatus_Divorced", "MaritalStatus_Institution",
        "MaritalStatus_Married", "MaritalStatus_Single",
    ],
    "Gender": ["Gender_Female", "Gender_Institution", "Gender_Male"],
    "CampaignType": ["CampaignType_Awareness", "CampaignType_Lead Gen"],
    "PreferredLanguage": ["PreferredLanguage_Arabic", "PreferredLanguage_English"],
    "UTMCampaignFirstTouch": [
        "UTMCampaignFirstTouch_aos", "UTMCampaignFirstTouch_argaam",
        "UTMCampaignFirstTouch_club", "UTMCampaignFirstTouch_direct traffic",
        "UTMCampaignFirstTouch_diverse", "UTMCampaignFirstTouch_lookalike",
        "UTMCampaignFirstTouch_organic", "UTMCampaignFirstTouch_osol",
        "UTMCampaignFirstTouch_others", "UTMCampaignFirstTouch_professional",
        "UTMCampaignFirstTouch_retire",
    ],
    "UTMSourceFirstTouch": [
        "UTMSourceFirstTouch_Argaam", "UTMSourceFirstTouch_Client App",
        "UTMSourceFirstTouch_Direct traffic", "UTMSourceFirstTouch_Email Marketing",
        "UTMSourceFirstTouch_Facebook", "UTMSourceFirstTouch_GDN",
        "UTMSourceFirstTouch_GMB", "UTMSourceFirstTouch_Instagram",
        "UTMSourceFirstTouch_Integration", "UTMSourceFirstTouch_Linkedin",
        "UTMSourceFirstTouch_Offline (import)", "UTMSourceFirstTouch_Offline (sales contacts)",
        "UTMSourceFirstTouch_Old Webinar (Integration)", "UTMSourceFirstTouch_Organic",
        "UTMSourceFirstTouch_Referrals", "UTMSourceFirstTouch_Scheduler App",
        "UTMSourceFirstTouch_Search", "UTMSourceFirstTouch_Snapchat",
        "UTMSourceFirstTouch_Social media (organic)", "UTMSourceFirstTouch_Twitter",
        "UTMSourceFirstTouch_Whatsapp", "UTMSourceFirstTouch_tfo-website",
    ],
    "Country": [
        "Country_Bahrain", "Country_Kuwait", "Country_Other",
        "Country_Saudi Arabia", "Country_United Arab Emirates",
    ],
    "FirstPageSeen": [
        "FirstPageSeen_Facebook", "FirstPageSeen_Other",
        "FirstPageSeen_PJ", "FirstPageSeen_Website", "FirstPageSeen_linkedin",
    ],
    "Nationality": ["Nationality_bahrain", "Nationality_indian", "Nationality_saudi arabia"],
}
