"""Column names and fixed values shared by the whole package."""

# Column names of the stored daily tables and of the raw station files.
STATION = "STATION_NUMBER"
DATE = "Date"
PARAMETER = "Parameter"
VALUE = "Value"
PUB_STATUS = "pub_status"
APPROVAL = "Approval"
GRADE = "Grade"
STATUS = "STATION_OPERATING_STATUS"
PROVINCE = "PROV_TERR_STATE_LOC"

DAY_KEYS = (STATION, DATE)
DAY_PARAM_KEYS = (STATION, DATE, PARAMETER)
STORED_COLUMNS = (STATION, DATE, PARAMETER, VALUE, PUB_STATUS)

# They must equal the reference's for equal results.
PUBLISHED = "Published"
UNPUBLISHED = "Unpublished"
FLOW = "Flow"
LEVEL = "Level"
DISCONTINUED = "DISCONTINUED"
RAW_PREAMBLE_LINES = 9  # raw station files: 9 lines, then the header
RELEASE_MARKER = "Hydat_sqlite3_"  # archive file names carry the release stamp after this
DAYS_PER_MONTH = 30.4167
ISSUE_NO_LINKS = "Unable to find download links/no downloadable data found"
ISSUE_ALL_EMPTY = "All data files are empty"
ISSUE_FATAL = "A fatal error occured during data download for this station"
REALTIME_REPORT_URL = "https://wateroffice.ec.gc.ca/report/real_time_e.html"
REALTIME_REPORT_QUERY = "&mode=Graph&startDate={start}&endDate={end}&prm1=46&y1Max=&y1Min=&prm2=-1&y2Max=&y2Min="
