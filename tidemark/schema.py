"""The fact table, its sources' names and its dimensions. Pure data."""

from __future__ import annotations

from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType

# Fixed values: (fact column, feed field, CSV header, rule). Rule: a clip width, or key, date, double, text, point.
COLUMNS = (
    ("Unique_Key", "unique_key", "Unique Key", "key"),
    ("Created_Date", "created_date", "Created Date", "date"),
    ("Closed_Date", "closed_date", "Closed Date", "date"),
    ("Agency", "agency", "Agency", 6),
    ("Agency_Name", "agency_name", "Agency Name", 50),
    ("Problem", "complaint_type", "Problem (formerly Complaint Type)", 40),
    ("Problem_Detail", "descriptor", "Problem Detail (formerly Descriptor)", 50),
    ("Additional_Details", None, "Additional Details", 40),
    ("Location_Type", "location_type", "Location Type", 30),
    ("Incident_Zip", "incident_zip", "Incident Zip", 255),
    ("Incident_Address", "incident_address", "Incident Address", 50),
    ("Street_Name", "street_name", "Street Name", 50),
    ("Cross_Street_1", "cross_street_1", "Cross Street 1", 30),
    ("Cross_Street_2", "cross_street_2", "Cross Street 2", 30),
    ("Intersection_Street_1", "intersection_street_1", "Intersection Street 1", 30),
    ("Intersection_Street_2", "intersection_street_2", "Intersection Street 2", 30),
    ("Address_Type", "address_type", "Address Type", 15),
    ("City", "city", "City", 25),
    ("Landmark", "landmark", "Landmark", 30),
    ("Facility_Type", "facility_type", "Facility Type", 20),
    ("Status", "status", "Status", 15),
    ("Due_Date", "due_date", "Due Date", "date"),
    ("Resolution_Description", "resolution_description", "Resolution Description", "text"),
    ("Resolution_Action_Updated_Date", "resolution_action_updated_date", "Resolution Action Updated Date", "date"),
    ("Community_Board", "community_board", "Community Board", 30),
    ("Council_Dicharict", "council_district", "Council District", 255),
    ("Police_Precinct", "police_precinct", "Police Precinct", 20),
    ("BBL", "bbl", "BBL", "double"),
    ("Borough", "borough", "Borough", 15),
    ("X_Coordinate_State_Plane", "x_coordinate_state_plane", "X Coordinate (State Plane)", 15),
    ("Y_Coordinate_State_Plane", "y_coordinate_state_plane", "Y Coordinate (State Plane)", 15),
    ("Open_Data_Channel_Type", "open_data_channel_type", "Open Data Channel Type", 20),
    ("Park_Facility_Name", "park_facility_name", "Park Facility Name", 15),
    ("Park_Borough", "park_borough", "Park Borough", 20),
    ("Vehicle_Type", "vehicle_type", "Vehicle Type", 15),
    ("Taxi_Company_Borough", "taxi_company_borough", "Taxi Company Borough", 25),
    ("Taxi_Pick_Up_Location", "taxi_pick_up_location", "Taxi Pick Up Location", 125),
    ("Bridge_Highway_Name", "bridge_highway_name", "Bridge Highway Name", 25),
    ("Bridge_Highway_Direction", "bridge_highway_direction", "Bridge Highway Direction", 125),
    ("Road_Ramp", "road_ramp", "Road Ramp", 125),
    ("Bridge_Highway_Segment", "bridge_highway_segment", "Bridge Highway Segment", 15),
    ("Latitude", "latitude", "Latitude", "double"),
    ("Longitude", "longitude", "Longitude", "double"),
    ("Location", "location", "Location", "point"),
)
#: Fixed value: clip width of the point's text.
POINT_WIDTH = 255
#: Fixed values: (fact text column, dimension, its name column, fact id column).
DIMENSIONS = (
    ("Agency_Name", "agencies", "agency_name", "agency_id"),
    ("Community_Board", "community_boards", "community_board_name", "cb_id"),
    ("Location_Type", "location_types", "location_type_name", "lt_id"),
    ("Address_Type", "address_types", "address_type_name", "at_id"),
)
#: Texts that a CSV export means as missing, beside the empty text.
CSV_NULLS = ("", "nan", "NaN", "NAN", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "None", "n/a", "null")
#: Pattern of CSV dates, and headers without which a file is refused.
CSV_DATE, REQUIRED_HEADERS = "MM/dd/yyyy hh:mm:ss a", ("Unique Key", "Created Date")
#: Fixed values of the feed's protocol.
KEY, CHANGED, CREATED = "unique_key", ":updated_at", "created_date"

#: Version of the schema above and of the store's layout; a store of another is refused.
FORMAT = 2

DATES = tuple(c for c, _, _, rule in COLUMNS if rule == "date")
WIDTHS = {c: rule for c, _, _, rule in COLUMNS if isinstance(rule, int)} | {"Location": POINT_WIDTH}
FEED_FIELDS = tuple(f for _, f, _, _ in COLUMNS if f)
IDS = tuple(i for _, _, _, i in DIMENSIONS)
#: Columns that a feed load may write: all but the one that only the CSV has.
FEED_TARGETS = tuple(c for c, f, _, _ in COLUMNS if f) + IDS
_KINDS = {"key": LongType(), "date": TimestampNTZType(), "double": DoubleType()}
FACT = StructType([StructField(c, _KINDS.get(rule, StringType()), rule != "key") for c, _, _, rule in COLUMNS] + [StructField(i, IntegerType()) for i in IDS])
FEED = StructType([StructField(f, StringType()) for f in (*FEED_FIELDS, CHANGED)])
