"""Fixed values of the domain: labels, class ids, thresholds, camera settings."""

# Traffic status labels.
STATUS_EMPTY = "SEPI"
STATUS_FREE = "LANCAR"
STATUS_DENSE = "PADAT"
STATUS_JAMMED = "MACET"
STATUS_WAITING = "MENUNGGU"

# Status thresholds (vehicles, km/h).
FEW_VEHICLES = 2
JAM_BELOW_KMH = 10.0
DENSE_BELOW_KMH = 30.0

# Detector class id -> vehicle type.
VEHICLE_CLASSES = {2: "car", 3: "motorcycle", 5: "bus", 7: "truck"}
UNKNOWN_TYPE = "unknown"

# Validity limits.
MAX_SPEED_KMH = 150.0
MIN_LIVE_CONFIDENCE = 0.3
MAX_PLAUSIBLE_KMH = 300.0
HEAT_FULL_SCALE_KMH = 80.0
ANOMALY_ABOVE_KMH = 200.0
DETECTION_CONFIDENCE = 0.5
CALIBRATION_CONFIDENCE = 0.3
NMS_IOU = 0.7

# Clocks and windows.
ZONE = "Asia/Jakarta"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
LIVE_WINDOW = "5 seconds"
LIVE_WATERMARK = "5 seconds"
LIVE_TRIGGER = "30 seconds"
LIVE_RECORDS_PER_TRIGGER = 3000
HOURLY_WINDOW_MINUTES = 60
HOURLY_RECORDS_PER_TRIGGER = 20_000
TRACK_TIMEOUT = "5 seconds"
DEFAULT_FPS = 25.0
MAX_FPS = 60

# Trajectory lengths.
PATH_POINTS = 30
SMOOTH_SPEEDS = 10
SMOOTH_MIN_SPEEDS = 3
SMOOTH_BOXES = 5

# Columns the hourly job refuses to run without.
REQUIRED_COLUMNS = ["source_id", "tracker_id", "vehicle_type", "speed_kmh", "timestamp"]

# Dashboard texts.
CAMERA_LABELS = {"cam_01": "Kamera 1", "cam_02": "Kamera 2"}
CAMERA_PLACES = {"cam_01": "Simpang Ciawi"}
DEFAULT_PLACE = "Depan Balaikota Bogor"
SEVERITY_HIGH = "Tinggi"
SEVERITY_MEDIUM = "Sedang"
SEVERITY_INFO = "Info"
NO_LIVE_DATA_TITLE = "Belum ada data realtime"
NO_LIVE_DATA_TIME = "Menunggu sinkronisasi"

# Route cards (name, load, status) while there is no data.
WAITING_ROUTE_CARDS = [("Camera-01", 72, "PADAT"), ("Camera-02", 58, "LANCAR")]
JUST_NOW = "baru saja"

# Camera calibration. (x, y) are frame pixels, target sizes are metres.
CAMERAS = [
    {
        "source_id": "cam_01",
        "roi": [(844, 267), (1106, 272), (1361, 521), (857, 538)],
        "target_w": 6.0,
        "target_h": 20.0,
    },
    {
        "source_id": "cam_02",
        "roi": [(443, 187), (875, 211), (809, 558), (10, 423)],
        "target_w": 14.0,
        "target_h": 20.0,
    },
]
CALIBRATION_CAMERAS = [
    {
        "source_id": "cam_01",
        "roi": [(846, 269), (1086, 271), (1327, 494), (861, 523)],
        "target_w": 5.0,
        "target_h": 12.0,
    },
    {
        "source_id": "cam_02",
        "roi": [(443, 187), (875, 211), (809, 558), (10, 423)],
        "target_w": 14.0,
        "target_h": 16.0,
    },
]
